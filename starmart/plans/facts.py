"""The six facts: totals by province or district and by day, month or year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.contracts import (
    GEOS,
    conform,
    conform_raw,
    fact_table,
    require_ansi,
    require_capacity,
)
from starmart.functions.periods import PERIODS
from starmart.operators.lookup import case_lookup
from starmart.operators.numbering import POSITION, between_positions, sorted_runs, with_position
from starmart.operators.totals import unpivot_measures, wide_totals
from starmart.parallel import in_parallel
from starmart.plans.dims import dim_case as case_rows
from starmart.spec import StarSpec
from starmart.staging import Staging

# Jobs that run side by side.
THREADS = 4


def geo_column(geo: str) -> str:
    return f"{geo}_id"


def period_totals(
    df: DataFrame, geo: str, period: str, date: str, code: str, measures: Sequence[str]
) -> DataFrame:
    """One row per period and place, with a total per measure. ``df`` may be
    the raw table or daily totals of it: sums of sums are the same, NULL totals
    included."""
    bucket = PERIODS[period]
    keys = [bucket.of(F.col(date)).alias(bucket.column), F.col(code).alias(geo_column(geo))]
    return wide_totals(df, keys, measures)


def sorted_totals(totals: DataFrame, geo: str, period: str, staging: Staging) -> DataFrame:
    """``period_totals`` staged in the order of period and place. Raises if the
    ids that follow from them do not fit, before anything is made of them."""
    keys = [PERIODS[period].column, geo_column(geo)]
    runs = sorted_runs(totals, keys, staging, fact_table(geo, period))
    measures = len(totals.columns) - len(keys)
    require_capacity(fact_table(geo, period), runs.count() * measures)
    return runs


def status_rows(runs: DataFrame, spec: StarSpec, geo: str, period: str) -> DataFrame:
    """The long form of ``sorted_totals`` with the fact id."""
    return placed_status_rows(with_position(runs), spec, geo, period)


def placed_status_rows(placed: DataFrame, spec: StarSpec, geo: str, period: str) -> DataFrame:
    """The long form of totals that have their place, with the fact id.

    Every period and place has all statuses, so the id in the order of period,
    place and status follows from the place of the wide row: the sort handles
    one row per period and place, not one per status.
    """
    ids = [POSITION, geo_column(geo), PERIODS[period].column]
    long = unpivot_measures(placed, ids, spec.statuses, value="total")
    status_place = F.array_position(F.array(*[F.lit(s) for s in spec.statuses]), F.col("status"))
    return long.withColumn("id", F.col(POSITION) * len(spec.statuses) + status_place).drop(POSITION)


def fact_of_ids(
    raw: DataFrame, spec: StarSpec, geo: str, period: str, first: int, last: int, staging: Staging
) -> DataFrame:
    """The rows of a fact with the ids from ``first`` to ``last``. The totals are
    sorted by place once; of the sorted runs those that hold the ids are read."""
    require_ansi(raw.sparkSession)
    records = conform_raw(raw, spec)
    totals = period_totals(records, geo, period, spec.date, spec.geo_code(geo), spec.measures)
    runs = sorted_totals(totals, geo, period, staging)
    per_place = len(spec.statuses)
    placed = between_positions(runs, (first - 1) // per_place, (last - 1) // per_place)
    lookup = case_lookup(staging.save(case_rows(runs, spec), "dim_case"), spec.statuses)
    rows = placed_status_rows(placed, spec, geo, period).join(lookup, "status")
    return conform(rows.where(F.col("id").between(first, last)), fact_table(geo, period))


def fact_rows(
    runs: DataFrame, lookup: DataFrame, spec: StarSpec, geo: str, period: str
) -> DataFrame:
    """Inner join with the case ids. The fact ids are given before: a status
    that the dimension lacks leaves gaps."""
    rows = status_rows(runs, spec, geo, period).join(lookup, "status")
    return conform(rows, fact_table(geo, period))


def fact(
    raw: DataFrame,
    dim_case: DataFrame | None,
    spec: StarSpec,
    geo: str,
    period: str,
    where: Column | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """One fact from the raw table; ``where`` filters the raw rows first.
    Without ``dim_case`` its rows are those that the raw table gives, known
    from the staged totals, so the raw table is read once.

    The totals are computed and staged at once, by a few Spark jobs. The result
    reads them, so their folder has to stay until it is used: pass ``staging``
    to drop it afterwards.
    """
    require_ansi(raw.sparkSession)
    records = conform_raw(raw if where is None else raw.where(where), spec)
    staging = staging or Staging(raw.sparkSession)
    totals = period_totals(records, geo, period, spec.date, spec.geo_code(geo), spec.measures)
    if dim_case is None:
        runs = sorted_totals(totals, geo, period, staging)
        lookup = case_lookup(staging.save(case_rows(runs, spec), "dim_case"), spec.statuses)
        return fact_rows(runs, lookup, spec, geo, period)
    parts = in_parallel(
        staging.spark,
        {
            "runs": partial(sorted_totals, totals, geo, period, staging),
            "lookup": partial(case_lookup, dim_case, spec.statuses),
        },
        THREADS,
    )
    return fact_rows(parts["runs"], parts["lookup"], spec, geo, period)


def all_facts(
    daily: DataFrame, dim_case: DataFrame, spec: StarSpec, staging: Staging
) -> dict[str, DataFrame]:
    """The six facts from totals by day, province and district. Months and
    years are summed from the daily totals of their own kind of place."""

    def runs(geo: str, period: str, df: DataFrame, date: str, code: str) -> DataFrame:
        totals = period_totals(df, geo, period, date, code, spec.measures)
        return sorted_totals(totals, geo, period, staging)

    first = in_parallel(
        staging.spark,
        {(g, "daily"): partial(runs, g, "daily", daily, spec.date, spec.geo_code(g)) for g in GEOS}
        | {"lookup": partial(case_lookup, dim_case, spec.statuses)},
        THREADS,
    )
    lookup = first.pop("lookup")
    date = PERIODS["daily"].column
    longer = in_parallel(
        staging.spark,
        {
            (g, p): partial(runs, g, p, first[g, "daily"], date, geo_column(g))
            for g in GEOS
            for p in PERIODS
            if p != "daily"
        },
        THREADS,
    )
    parts = first | longer
    return {
        fact_table(g, p): fact_rows(parts[g, p], lookup, spec, g, p) for g in GEOS for p in PERIODS
    }
