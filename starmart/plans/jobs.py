"""The jobs: land the source, build the dimensions, build the facts.

Each job reads the raw table once. Errors raise, and nothing is written to the
warehouse before all tables are summed, sorted and checked. A file warehouse
then changes all tables of the job at once or none.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.contracts import (
    PRIMARY_KEYS,
    ContractError,
    conform_raw,
    conform_some,
    require_ansi,
)
from starmart.functions.names import quoted
from starmart.functions.periods import date_violations
from starmart.operators.flatten import RECORDS, field_names, fields_of, having_any
from starmart.operators.keys import key_violations
from starmart.operators.totals import wide_totals
from starmart.parallel import in_parallel
from starmart.plans.dims import dim_case, dim_district, dim_province
from starmart.plans.facts import all_facts
from starmart.sinks.files import land
from starmart.sinks.warehouse import Warehouse
from starmart.sources.files import read_csv_text, read_records
from starmart.spec import CASE_SPEC, StarSpec
from starmart.staging import Staging

SHOWN_VIOLATIONS = 20


def ingest(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    schema: T.StructType | None = None,
    records: str = RECORDS,
    multi_line: bool = False,
    partitions: int | None = None,
    fmt: str = "parquet",
    spec: StarSpec = CASE_SPEC,
    by_day: bool = False,
    split: bool = False,
    **options,
) -> None:
    """Lands the records of JSON documents as a flat table with lower-case
    names: all their fields, found by a pass over the documents, or those of
    ``schema`` without one. Names match in any spelling, from record to record. The
    columns of ``spec`` get their declared types and those of ``schema`` theirs,
    others stay text; a count that is no integer raises, and so does a record that has
    fields but none of ``schema``.

    ``multi_line`` documents, one per file, come from one task each, whose rows
    ``partitions`` spreads; with ``split`` many tasks read each. ``by_day`` lands
    the rows in the order of days, at the price of a sort, so that a filter on days
    skips files."""
    require_ansi(spark)
    with Staging(spark) as staging:
        found = read_records(spark, source, records, multi_line, split, staging)
        if schema is None:
            flat = fields_of(found, field_names(found))
        else:
            declared = _record_fields(schema, records)
            names = [f.name.lower() for f in declared]
            flat = _typed(fields_of(having_any(found, names), names), declared)
        flat = conform_some(flat, spec)
        spread = flat if partitions is None else flat.repartition(partitions)
        land(spread, target, fmt, sort_by=[spec.date] if by_day else (), **options)


def _record_fields(schema: T.StructType, records: str) -> T.StructType:
    """The fields of the records in the schema of documents."""
    kind = schema
    for key in records.split("."):
        kind = kind[key].dataType
    fields = kind.elementType
    clashes = sorted(n for n, k in Counter(f.name.lower() for f in fields).items() if k > 1)
    if clashes:
        raise ValueError(f"fields differ by case only: {clashes}")
    return fields


def _typed(flat: DataFrame, fields: T.StructType) -> DataFrame:
    """Text columns, in the order of ``fields``, with their types."""

    def typed(field: T.StructField) -> Column:
        column = F.col(quoted(field.name.lower()))
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.from_json(column, field.dataType, {"mode": "FAILFAST"}).alias(field.name.lower())
        return column.cast(field.dataType).alias(field.name.lower())

    return flat.select(*map(typed, fields))


def build_dims(
    raw: DataFrame, spec: StarSpec, warehouse: Warehouse, check_keys: bool = True
) -> None:
    """Builds and stores the three dimensions."""
    require_ansi(raw.sparkSession)
    with Staging(raw.sparkSession) as staging:
        warehouse.publish(checked_dims(conform_raw(raw, spec), spec, staging, check_keys))


def build_facts(
    raw: DataFrame,
    spec: StarSpec,
    warehouse: Warehouse,
    strict_dates: bool = False,
    check_keys: bool = True,
) -> None:
    """Builds and stores the six facts; reads ``dim_case`` from the warehouse.
    It has to hold every status of a raw table with rows once, with ids that
    are neither NULL nor repeated; without ``check_keys`` what does not match is
    left out by the inner join."""
    spark = raw.sparkSession
    require_ansi(spark)
    keys = [spec.date, spec.province_code, spec.district_code]
    with Staging(spark) as staging:
        cases = staging.save(warehouse.load(spark, "dim_case"), "dim_case")
        daily = staging.save(_grouped(conform_raw(raw, spec), keys, spec), "daily")
        check_dates(daily, spec, strict_dates)
        if check_keys:
            _check_cases(cases, daily, spec)
        warehouse.publish(all_facts(daily, cases, spec, staging))


def build_all(
    raw: DataFrame,
    spec: StarSpec,
    warehouse: Warehouse,
    check_keys: bool = True,
    strict_dates: bool = False,
) -> None:
    """Builds and stores all nine tables from one pass over the raw table."""
    require_ansi(raw.sparkSession)
    with Staging(raw.sparkSession) as staging:
        daily = staging.save(_grouped(conform_raw(raw, spec), spec.keys, spec), "daily")
        check_dates(daily, spec, strict_dates)
        cases = dim_case(daily, spec)
        built = in_parallel(
            staging.spark,
            {
                "dims": partial(checked_dims, daily, spec, staging, check_keys),
                "facts": partial(all_facts, daily, cases, spec, staging),
            },
            2,
        )
        warehouse.publish(built["dims"] | built["facts"])


def copy_csv(
    spark: SparkSession, path: str, warehouse: Warehouse, table: str, sep: str = ",", **options
) -> None:
    """Stores a CSV file with a header as a table of text columns."""
    warehouse.save(read_csv_text(spark, path, sep, **options), table)


def row_counts(spark: SparkSession, warehouse: Warehouse, tables) -> DataFrame:
    """The number of rows of each table, all of one publication."""
    warehouse = warehouse.pinned(spark)
    counts = [
        warehouse.load(spark, t).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(t).alias("table_name"), "n"
        )
        for t in tables
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionAll(other)
    return result


def preview(df: DataFrame, rows: int = 20) -> None:
    """Prints the first rows. Runs the plan of ``df``, so not part of a job."""
    df.show(rows, truncate=False)


def _grouped(raw: DataFrame, keys, spec: StarSpec) -> DataFrame:
    return wide_totals(raw, [F.col(k) for k in keys], spec.measures)


def checked_dims(
    raw: DataFrame, spec: StarSpec, staging: Staging, check_keys: bool
) -> dict[str, DataFrame]:
    """The three dimensions by name. Bad keys raise."""
    places = staging.save(raw.select(*spec.keys[1:]).distinct(), "places")
    dims = {
        "dim_province": dim_province(places, spec),
        "dim_district": dim_district(places, spec),
        "dim_case": dim_case(places, spec),
    }
    if check_keys:
        checks = {
            table: partial(_raise_if_any, key_violations(dims[table], keys), f"{table} has bad keys")
            for table, keys in PRIMARY_KEYS.items()
        }
        in_parallel(staging.spark, checks, len(checks))
    return dims


def _check_cases(cases: DataFrame, daily: DataFrame, spec: StarSpec) -> None:
    """``cases`` has a row or so per status; only a few more are ever shown."""
    _raise_if_any(key_violations(cases, ["id"]), "dim_case has bad ids")
    known = cases.where(F.col("status").isin(list(spec.statuses)))
    _raise_if_any(key_violations(known, ["status"]), "dim_case repeats a status")
    found = known.count()
    if found != len(spec.statuses) and not daily.isEmpty():
        raise ContractError(f"dim_case has {found} of the {len(spec.statuses)} statuses")


def check_dates(daily: DataFrame, spec: StarSpec, strict: bool) -> None:
    if strict:
        _raise_if_any(date_violations(daily, spec.date), "dates are not yyyy-MM-dd")


def _raise_if_any(violations: DataFrame, message: str) -> None:
    shown = violations.orderBy(*violations.columns).limit(SHOWN_VIOLATIONS).collect()
    if shown:
        first = f" (first {SHOWN_VIOLATIONS})" if len(shown) == SHOWN_VIOLATIONS else ""
        raise ContractError(f"{message}{first}: {[r.asDict() for r in shown]}")
