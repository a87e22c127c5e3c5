"""Gapless numbers in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.names import quoted
from starmart.staging import Staging

POSITION = "_position"

_SLOT = "_slot"
_PART = "_part"
_BEFORE = "_before"
# monotonically_increasing_id() holds the partition above bit 33 and the row
# within the partition below.
_ROW_BITS = 33


def sorted_runs(df: DataFrame, keys: Sequence[str], staging: Staging, name: str) -> DataFrame:
    """Stages ``df`` sorted by ``keys``, NULLs first, with the place of each row
    in its sort partition. No two rows may share the same keys.

    The range-partitioned sort gives each partition a run of the order, however
    many rows one period holds. It has to be staged: a second run of the sort
    could draw other partition bounds.
    """
    order = [F.col(quoted(k)).asc_nulls_first() for k in keys]
    return staging.save(df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id()), name)


def with_position(runs: DataFrame) -> DataFrame:
    """Adds the 0-based place of each row in the whole order.

    What the runs lack is the number of rows in the partitions before. That is
    a table with one row per sort partition, at most spark.sql.shuffle.partitions
    rows however large the data, so one task adds it up and it is broadcast.
    """
    runs = runs.withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS))
    sizes = runs.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE))
    row = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        runs.join(F.broadcast(starts), _PART)
        .withColumn(POSITION, F.col(_BEFORE) + row)
        .drop(_PART, _SLOT, _BEFORE)
    )


def between_positions(runs: DataFrame, first: int, last: int) -> DataFrame:
    """``with_position`` for the rows from place ``first`` to ``last`` alone.

    The sizes of the runs, one number per sort partition, tell which of them hold
    the places, and where. The filter is a range of the stored slots, so files of
    other runs are skipped, and nothing is sorted.
    """
    part = F.shiftright(_SLOT, _ROW_BITS)
    sizes = runs.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("n")).collect()
    wanted, position, before = F.lit(False), F.lit(None).cast("bigint"), 0
    for run in sorted(sizes, key=lambda r: r[_PART]):
        low, high = max(first, before), min(last, before + run["n"] - 1)
        if low <= high:
            start = run[_PART] << _ROW_BITS
            held = F.col(_SLOT).between(start + low - before, start + high - before)
            wanted |= held
            position = F.when(held, F.col(_SLOT) - start + before).otherwise(position)
        before += run["n"]
    return runs.where(wanted).withColumn(POSITION, position).drop(_SLOT)
