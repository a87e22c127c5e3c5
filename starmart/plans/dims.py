"""The three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.contracts import conform
from starmart.functions.status import status_detail, status_name
from starmart.spec import StarSpec


def dim_province(raw: DataFrame, spec: StarSpec) -> DataFrame:
    """Distinct codes and names; two spellings of a name stay two rows."""
    rows = raw.select(
        F.col(spec.province_code).alias("province_id"),
        F.col(spec.province_name).alias("province_name"),
    )
    return conform(rows, "dim_province").distinct()


def dim_district(raw: DataFrame, spec: StarSpec) -> DataFrame:
    rows = raw.select(
        F.col(spec.district_code).alias("district_id"),
        F.col(spec.province_code).alias("province_id"),
        F.col(spec.district_name).alias("district_name"),
    )
    return conform(rows, "dim_district").distinct()


def dim_case(raw: DataFrame, spec: StarSpec) -> DataFrame:
    """The measure names, numbered in their order; empty if ``raw`` is empty.

    Any one row of ``raw`` will do: no column is read, and each task ends with
    its first row.
    """
    some = raw.select(F.lit(1).alias("n")).limit(1)
    statuses = F.array(*[F.lit(s) for s in spec.statuses])
    numbered = some.select(F.posexplode(statuses).alias("place", "status"))
    status = F.col("status")
    rows = numbered.select(
        (F.col("place") + 1).alias("id"),
        "status",
        status_name(status).alias("status_name"),
        status_detail(status).alias("status_detail"),
    )
    return conform(rows, "dim_case")
