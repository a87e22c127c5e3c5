"""Primary-key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.names import quoted


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once or hold a NULL, with row counts."""
    has_null = reduce(or_, [F.col(quoted(k)).isNull() for k in keys])
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) | has_null)
    )
