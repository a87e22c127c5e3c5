
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starmart import (  # noqa: E402
    TABLES,
    Staging,
    build_all,
    build_dims,
    build_facts,
    copy_csv,
    dim_case,
    dim_district,
    dim_province,
    fact,
    ingest,
)
from starmart.contracts import FACTS, GEOS, fact_table  # noqa: E402
from starmart.functions.periods import PERIODS, in_period  # noqa: E402
from starmart.functions.status import status_detail, status_name  # noqa: E402
from starmart.operators.flatten import flatten_records  # noqa: E402
from starmart.operators.keys import key_violations  # noqa: E402
from starmart.operators.totals import unpivot_measures  # noqa: E402
from starmart.plans.facts import (  # noqa: E402
    fact_of_ids,
    period_totals,
    sorted_totals,
    status_rows,
)
from starmart.plans.jobs import row_counts  # noqa: E402
from starmart.plans.refresh import StarState, refresh_all  # noqa: E402
from starmart.sinks.files import land  # noqa: E402
from starmart.sinks.warehouse import FileWarehouse  # noqa: E402
from starmart.sources.files import CSV_LOSSLESS, read_csv, read_parquet  # noqa: E402
from starmart.sources.shipments import (  # noqa: E402
    SHIPMENT_SPEC,
    shipment_documents,
    shipment_records,
)

# The folders of these operators may be absent; nothing else needs them.
try:
    import corpus_pipeline
    from starmart.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    # Or a package that they need and nothing else does.
    optional = ("corpus_pipeline", "starmart.llm", "starmart.llm.queries")
    if missing.name not in (*optional, "regex", "xxhash", "public_tokenizers"):
        raise
    CORPUS, CORPUS_SQL = {}, {}
else:
    CORPUS = {**corpus_queries.QUERIES, "pipeline": corpus_pipeline.run}
    CORPUS_SQL = corpus_queries.ORACLE_SQL | (
        {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    )

SPEC = SHIPMENT_SPEC
DAY = date(1999, 6, 30)
MONTH = "1998-09"
DAYS = ("1997-02-25", "1997-03-03")
PREVIEW_ROWS = 20
REFRESHES = 3


def entry(spark: SparkSession) -> DataFrame:
    """Monthly totals by province and case."""
    return queries()["fact_province_monthly"](spark, "/root/testdata/sf0.001")


def _cases(spark: SparkSession, folder: str) -> DataFrame:
    return dim_case(shipment_records(spark, folder), SPEC)


def _fact(spark: SparkSession, folder: str, geo: str, period: str) -> DataFrame:
    return fact(shipment_records(spark, folder), None, SPEC, geo, period)


def _flatten_nested_records(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_records(shipment_documents(spark, folder)).withColumnsRenamed(
        {m.lower(): m for m in SPEC.measures}
    )


def _json_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON lines, ingested, and the landed table read."""
    staging = Staging(spark)
    documents = shipment_documents(spark, folder)
    documents.write.json(staging.folder("documents"))
    ingest(spark, staging.folder("documents"), staging.folder("raw"), documents.schema)
    return read_parquet(spark, staging.folder("raw"), SPEC)


def _json_ingest_any_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of three records, each with its own spelling of the fields and
    without those that are NULL; the landed table is read."""
    staging = Staging(spark)
    raw = shipment_records(spark, folder)
    raw = staging.save(raw.withColumn("n", F.monotonically_increasing_id()), "numbered")
    spellings = [str.upper, str.lower, str.title]
    record = F.coalesce(
        *[
            F.when(F.col("n") % 3 == i, F.to_json(F.struct(*[F.col(c).alias(spell(c)) for c in SPEC.columns])))
            for i, spell in enumerate(spellings)
        ]
    )
    documents = (
        raw.groupBy(F.floor(F.col("n") / 3))
        .agg(F.array_join(F.collect_list(record), ",").alias("records"))
        .select(F.concat(F.lit('{"data": {"content": ['), "records", F.lit("]}}")).alias("value"))
    )
    documents.write.text(staging.folder("documents"))
    ingest(spark, staging.folder("documents"), staging.folder("raw"), spec=SPEC)
    return read_parquet(spark, staging.folder("raw"), SPEC)


def _json_ingest_split(spark: SparkSession, folder: str) -> DataFrame:
    """All records as one document in one file, some with braces and escapes in a
    text or nested values, ingested by tasks that read a part of the file each."""
    staging = Staging(spark)
    raw = shipment_records(spark, folder)
    raw = staging.save(raw.withColumn("n", F.monotonically_increasing_id()), "numbered")
    odd = F.when(F.col("n") % 5 == 0, F.lit('}], {"tanggal": "x\\" \\\\ } [')).alias("note")
    nested = F.when(
        F.col("n") % 7 == 0, F.struct(F.array(F.struct(F.lit("}{").alias("content"))).alias("content"))
    ).alias("data")
    columns = [F.col(c).alias(c.upper()) for c in SPEC.columns]
    first = raw.agg(F.min("n")).first()[0]
    comma = F.when(F.col("n") == first, "").otherwise(",")
    rows = raw.select("n", F.concat(comma, F.to_json(F.struct(odd, *columns, nested))).alias("value"))
    ends = [(-1, '{"status": 200, "data": {"content": ['), ((1 << 63) - 1, ']}, "message": "ok }"}')]
    whole = rows.unionByName(spark.createDataFrame(ends, rows.schema))
    whole.repartition(1).sortWithinPartitions("n").select("value").write.text(staging.folder("document"))
    ingest(spark, staging.folder("document"), staging.folder("raw"), spec=SPEC, split=True)
    return read_parquet(spark, staging.folder("raw"), SPEC)


def _csv_landing_default(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).folder("raw_csv")
    land(shipment_records(spark, folder), path, "csv")
    return read_csv(spark, path, SPEC)


def _csv_landing_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).folder("raw_csv")
    land(shipment_records(spark, folder), path, "csv", **CSV_LOSSLESS)
    return read_csv(spark, path, SPEC, **CSV_LOSSLESS)


def _csv_text_copy(spark: SparkSession, folder: str) -> DataFrame:
    """CSV with a header copied to a warehouse table of text columns."""
    staging = Staging(spark)
    warehouse = FileWarehouse(staging.folder("warehouse"))
    land(shipment_records(spark, folder), staging.folder("raw_csv"), "csv")
    copy_csv(spark, staging.folder("raw_csv"), warehouse, "raw_copy")
    return warehouse.load(spark, "raw_copy")


def _unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    raw = shipment_records(spark, folder)
    return unpivot_measures(raw, [SPEC.date, SPEC.province_code], SPEC.measures)


def _period_and_status_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Record counts and totals by the parts of date and status."""
    raw = shipment_records(spark, folder)
    long = unpivot_measures(raw, [SPEC.date], SPEC.measures)
    day, status = F.col(SPEC.date), F.col("status")
    return long.groupBy(
        PERIODS["monthly"].of(day).alias("month"),
        PERIODS["yearly"].of(day).alias("year"),
        status_name(status).alias("status_name"),
        status_detail(status).alias("status_detail"),
    ).agg(F.count("count").alias("n"), F.sum("count").alias("total"))


def _fact_filtered_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """One day of a table that was landed in the order of days."""
    path = Staging(spark).folder("raw")
    land(shipment_records(spark, folder), path, sort_by=[SPEC.date])
    raw = read_parquet(spark, path, SPEC)
    where = F.col(SPEC.date) == DAY.isoformat()
    return fact(raw, None, SPEC, "district", "daily", where=where)


def _dense_fact_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The fact id of each key, before any join."""
    raw = shipment_records(spark, folder)
    totals = period_totals(raw, "district", "daily", SPEC.date, SPEC.district_code, SPEC.measures)
    runs = sorted_totals(totals, "district", "daily", Staging(spark))
    rows = status_rows(runs, SPEC, "district", "daily")
    return rows.select(F.col("id").cast("int").alias("id"), "date", "district_id", "status")


def _key_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Days and districts with more than one raw row."""
    return key_violations(shipment_records(spark, folder), [SPEC.date, SPEC.district_code])


def _fact_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a console preview of a fact shows, in the order of ids."""
    raw = shipment_records(spark, folder)
    rows = fact_of_ids(raw, SPEC, "province", "daily", 1, PREVIEW_ROWS, Staging(spark))
    return rows.orderBy("id")


def _fact_of_one_month(spark: SparkSession, folder: str) -> DataFrame:
    """Daily totals of a month of a landed table; the filter reaches the scan."""
    path = Staging(spark).folder("raw")
    land(shipment_records(spark, folder), path, sort_by=[SPEC.date])
    where = in_period(F.col(SPEC.date), "monthly", MONTH)
    return fact(read_parquet(spark, path, SPEC), None, SPEC, "district", "daily", where=where)


def _fact_of_some_days(spark: SparkSession, folder: str) -> DataFrame:
    """Daily totals of a week of a table that was landed with file statistics."""
    path = Staging(spark).folder("raw")
    land(shipment_records(spark, folder), path, sort_by=[SPEC.date], statistics=SPEC.date)
    raw = read_parquet(spark, path, SPEC, days=DAYS)
    return fact(raw, None, SPEC, "province", "daily")


def _csv_two_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings, the columns of one in reverse and with a further one, read as one."""
    staging = Staging(spark)
    raw = staging.save(shipment_records(spark, folder), "raw")
    half = F.crc32(F.col(SPEC.date).cast("binary")) % 2 == 0
    land(raw.where(half), staging.folder("csv/a"), "csv")
    turned = raw.where(~half).select(F.lit("x").alias("note"), *reversed(raw.columns))
    land(turned, staging.folder("csv/b"), "csv")
    return read_csv(spark, [staging.folder("csv/a"), staging.folder("csv/b")], SPEC)


def _one_job(spark: SparkSession, folder: str) -> FileWarehouse:
    warehouse = FileWarehouse(Staging(spark).folder("warehouse"))
    build_all(shipment_records(spark, folder), SPEC, warehouse)
    return warehouse


def _two_jobs(spark: SparkSession, folder: str) -> FileWarehouse:
    """Land, build dimensions, then facts with the stored ``dim_case``."""
    staging = Staging(spark)
    warehouse = FileWarehouse(staging.folder("warehouse"))
    land(shipment_records(spark, folder), staging.folder("raw"))
    raw = read_parquet(spark, staging.folder("raw"), SPEC)
    build_dims(raw, SPEC, warehouse)
    build_facts(raw, SPEC, warehouse)
    return warehouse


def _refreshed(spark: SparkSession, folder: str) -> tuple[StarState, FileWarehouse]:
    """Raw rows in three steps, each with every third day or so, and published."""
    staging = Staging(spark)
    raw = staging.save(shipment_records(spark, folder), "raw")
    state = StarState(staging.folder("state"), SPEC)
    warehouse = FileWarehouse(staging.folder("warehouse"))
    step = F.crc32(F.col(SPEC.date).cast("binary")) % REFRESHES
    for i in range(REFRESHES - 1):
        state.refresh(raw.where(step == i))
    refresh_all(raw.where(step == REFRESHES - 1), state, warehouse)
    return state, warehouse


def _fact_totals(spark: SparkSession, warehouse: FileWarehouse) -> DataFrame:
    """Rows, largest id and total by fact table and status, from stored tables."""
    warehouse = warehouse.pinned(spark)
    cases = warehouse.load(spark, "dim_case").select(F.col("id").alias("case_id"), "status")
    result = None
    for table in FACTS:
        totals = (
            warehouse.load(spark, table)
            .groupBy("case_id")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.max("id").alias("last_id"),
                F.sum("total").alias("total"),
            )
            .join(cases, "case_id")
            .select(F.lit(table).alias("table_name"), "status", "n", "last_id", "total")
        )
        result = totals if result is None else result.unionAll(totals)
    return result


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query takes (spark, folder of the tables)."""
    found = {
        "flatten_nested_records": _flatten_nested_records,
        "json_ingest": _json_ingest,
        "json_ingest_any_spelling": _json_ingest_any_spelling,
        "json_ingest_split": _json_ingest_split,
        "csv_landing_default": _csv_landing_default,
        "csv_two_headers": _csv_two_headers,
        "csv_landing_roundtrip": _csv_landing_roundtrip,
        "csv_text_copy": _csv_text_copy,
        "unpivot_measures": _unpivot_measures,
        "period_and_status_slices": _period_and_status_slices,
        "dim_province": lambda spark, folder: dim_province(shipment_records(spark, folder), SPEC),
        "dim_district": lambda spark, folder: dim_district(shipment_records(spark, folder), SPEC),
        "dim_case": _cases,
    }
    for geo in GEOS:
        for period in PERIODS:
            found[fact_table(geo, period)] = partial(_fact, geo=geo, period=period)
    return found | {
        "fact_filtered_by_date": _fact_filtered_by_date,
        "fact_of_one_month": _fact_of_one_month,
        "fact_of_some_days": _fact_of_some_days,
        "fact_preview": _fact_preview,
        "dense_fact_ids": _dense_fact_ids,
        "key_violations": _key_violations,
        "one_job_fact_totals": lambda s, folder: _fact_totals(s, _one_job(s, folder)),
        "two_job_fact_totals": lambda s, folder: _fact_totals(s, _two_jobs(s, folder)),
        "refreshed_fact_district_daily": lambda s, folder: _refreshed(s, folder)[0].facts(s)[
            "fact_district_daily"
        ],
        "refreshed_fact_totals": lambda s, folder: _fact_totals(s, _refreshed(s, folder)[1]),
        "star_row_counts": lambda s, folder: row_counts(s, _one_job(s, folder), TABLES),
        **CORPUS,
    }


# --- SQL twins ---------------------------------------------------------------

_MEASURE_SQL = ", ".join(
    f"CASE WHEN l_returnflag = '{m[0]}' AND l_linestatus = '{m[2]}' "
    f"THEN CAST(l_quantity AS BIGINT) END AS {m}"
    for m in SPEC.measures
)

_RAW = f"""raw AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS tanggal,
         CAST(r_regionkey AS VARCHAR) AS kode_prov, r_name AS nama_prov,
         CAST(n_nationkey AS VARCHAR) AS kode_kab, n_name AS nama_kab,
         {_MEASURE_SQL}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT tanggal, kode_prov, kode_kab, '{m}' AS status, {m} AS cnt FROM raw"
    for m in SPEC.measures
) + ")"

_CASES = """cases AS (
  SELECT CAST(row_number() OVER (ORDER BY status) AS INTEGER) AS id, status,
         string_split(status, '_')[1] AS status_name,
         string_split(status, '_')[2] AS status_detail
  FROM (SELECT DISTINCT status FROM long))"""

_WITH = f"WITH {_RAW}, {_LONG}, {_CASES}"

_PERIOD_SQL = {
    "daily": "tanggal",
    "monthly": "substr(tanggal, 1, 7)",
    "yearly": "string_split(tanggal, '-')[1]",
}
_CODE_SQL = {"province": "kode_prov", "district": "kode_kab"}


def _numbered_sql(geo: str, period: str, where: str = "TRUE") -> str:
    return f"""
      SELECT CAST(row_number() OVER (
               ORDER BY p NULLS FIRST, g NULLS FIRST, status) AS INTEGER) AS id, *
      FROM (SELECT {_PERIOD_SQL[period]} AS p, {_CODE_SQL[geo]} AS g, status,
                   CAST(SUM(cnt) AS BIGINT) AS total
            FROM long WHERE {where} GROUP BY 1, 2, 3)"""


def _fact_sql(geo: str, period: str, where: str = "TRUE") -> str:
    return f"""
      SELECT f.id, g AS {geo}_id, cases.id AS case_id, p AS {PERIODS[period].column}, total
      FROM ({_numbered_sql(geo, period, where)}) f JOIN cases USING (status)"""


def _fact_totals_sql() -> str:
    parts = [
        f"""SELECT '{fact_table(g, p)}' AS table_name, status, count(*) AS n,
                   max(f.id) AS last_id, CAST(SUM(total) AS BIGINT) AS total
            FROM ({_numbered_sql(g, p)}) f GROUP BY status"""
        for g in GEOS
        for p in PERIODS
    ]
    return _WITH + " UNION ALL ".join(parts)


_PROVINCES = "SELECT DISTINCT kode_prov AS province_id, nama_prov AS province_name FROM raw"
_DISTRICTS = (
    "SELECT DISTINCT kode_kab AS district_id, kode_prov AS province_id, "
    "nama_kab AS district_name FROM raw"
)


def _row_counts_sql() -> str:
    tables = {
        "dim_province": _PROVINCES,
        "dim_district": _DISTRICTS,
        "dim_case": "SELECT * FROM cases",
    } | {fact_table(g, p): _numbered_sql(g, p) for g in GEOS for p in PERIODS}
    return _WITH + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM ({sql})" for name, sql in tables.items()
    )


def oracle_sql() -> dict[str, str]:
    """The SQL twin of every query that SQL can express."""
    raw_rows = f"WITH {_RAW} SELECT * FROM raw"
    text_rows = f"WITH {_RAW} SELECT " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in SPEC.columns
    ) + " FROM raw"
    found = {
        "flatten_nested_records": raw_rows,
        "json_ingest": raw_rows,
        "json_ingest_any_spelling": raw_rows,
        "json_ingest_split": raw_rows,
        "csv_landing_default": raw_rows,
        "csv_two_headers": raw_rows,
        "csv_landing_roundtrip": raw_rows,
        "csv_text_copy": text_rows,
        "unpivot_measures": f"WITH {_RAW}, {_LONG} "
        'SELECT tanggal, kode_prov, status, cnt AS "count" FROM long',
        "period_and_status_slices": f"""WITH {_RAW}, {_LONG}
          SELECT substr(tanggal, 1, 7) AS month, string_split(tanggal, '-')[1] AS year,
                 string_split(status, '_')[1] AS status_name,
                 string_split(status, '_')[2] AS status_detail,
                 count(cnt) AS n, CAST(SUM(cnt) AS BIGINT) AS total
          FROM long GROUP BY 1, 2, 3, 4""",
        "dim_province": f"WITH {_RAW} {_PROVINCES}",
        "dim_district": f"WITH {_RAW} {_DISTRICTS}",
        "dim_case": f"{_WITH} SELECT * FROM cases",
    }
    for geo in GEOS:
        for period in PERIODS:
            found[fact_table(geo, period)] = _WITH + _fact_sql(geo, period)
    return found | {
        "fact_filtered_by_date": _WITH
        + _fact_sql("district", "daily", f"tanggal = '{DAY.isoformat()}'"),
        "fact_of_one_month": _WITH
        + _fact_sql("district", "daily", f"substr(tanggal, 1, 7) = '{MONTH}'"),
        "fact_of_some_days": _WITH
        + _fact_sql("province", "daily", f"tanggal BETWEEN '{DAYS[0]}' AND '{DAYS[1]}'"),
        "fact_preview": _WITH + _fact_sql("province", "daily") + f" ORDER BY 1 LIMIT {PREVIEW_ROWS}",
        "dense_fact_ids": _WITH
        + f"SELECT id, p AS date, g AS district_id, status FROM ({_numbered_sql('district', 'daily')})",
        "key_violations": f"""WITH {_RAW}
          SELECT tanggal, kode_kab, count(*) AS n FROM raw GROUP BY 1, 2
          HAVING count(*) > 1 OR tanggal IS NULL OR kode_kab IS NULL""",
        "one_job_fact_totals": _fact_totals_sql(),
        "two_job_fact_totals": _fact_totals_sql(),
        "refreshed_fact_district_daily": _WITH + _fact_sql("district", "daily"),
        "refreshed_fact_totals": _fact_totals_sql(),
        "star_row_counts": _row_counts_sql(),
        **CORPUS_SQL,
    }
