"""Other ways to the same results, to compare with."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.periods import PERIODS
from starmart.spec import StarSpec


def long_first_fact(
    raw: DataFrame, dim_case: DataFrame, spec: StarSpec, geo: str, period: str
) -> DataFrame:
    """The plain shape: unpivot, sum, number in one window over all rows, join."""
    bucket = PERIODS[period]
    place = f"{geo}_id"
    long = raw.unpivot(
        [spec.date, spec.geo_code(geo)], list(spec.measures), "status", "cnt"
    ).select(
        bucket.of(F.col(spec.date)).alias(bucket.column),
        F.col(spec.geo_code(geo)).alias(place),
        "status",
        "cnt",
    )
    totals = long.groupBy(bucket.column, place, "status").agg(F.sum("cnt").alias("total"))
    everything = Window.orderBy(bucket.column, place, "status")
    cases = dim_case.select("status", F.col("id").alias("case_id"))
    return (
        totals.withColumn("id", F.row_number().over(everything))
        .join(F.broadcast(cases), "status")
        .select("id", place, "case_id", bucket.column, "total")
    )


def rows(df: DataFrame) -> list[tuple]:
    """All rows, sorted, with NULLs first."""
    return sorted(
        (tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r]
    )
