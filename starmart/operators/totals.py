"""Wide totals and their long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.names import quoted


def wide_totals(df: DataFrame, keys: Sequence[Column], measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per key; NULL where a group has NULLs only.

    Summing comes before the unpivot, so each raw row is hashed once, not once
    per measure. The map side combines first: a key that holds a third of all
    rows reaches the shuffle as one row per map task.
    """
    sums = [F.expr(f"sum({quoted(m)}) AS {quoted(m)}") for m in measures]
    return df.groupBy(*keys).agg(*sums)


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    status: str = "status",
    value: str = "count",
) -> DataFrame:
    """One row per measure, NULLs included."""
    return df.unpivot([quoted(c) for c in ids], [quoted(m) for m in measures], status, value)
