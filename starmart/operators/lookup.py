"""Joins with small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Far above any list of case statuses, far below what an executor can hold.
BROADCAST_ROWS = 10_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks ``df`` for broadcast if a count proves it small. If not, Spark
    chooses the join, and adaptive execution splits skewed partitions."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def case_lookup(dim_case: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Status and case id of the rows of the dimension that can match."""
    cases = dim_case.where(F.col("status").isin(list(statuses))).select(
        "status", F.col("id").alias("case_id")
    )
    return broadcast_if_small(cases)
