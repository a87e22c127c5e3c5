"""Distributed LSD radix sort: stable counting passes over the digits of
composite keys.

A row has a place, and places are cut into blocks. A pass counts the rows by
digit and block, adds the counts up to the first place of every digit and block,
and moves each row there plus its rank within digit and block. A block bounds
what one group of the ranking holds, whatever digits the rows have; of the rows
themselves only counts meet across blocks. Each pass ends in a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.names import quoted
from starmart.staging import Staging

# At most so many bits in a digit, so many places in a block.
DIGIT_BITS = 11
BLOCK_BITS = 16
LEAST_BLOCK_BITS = 6
_SIGN = -(1 << 63)


def _digits(code: Column, bits: int) -> list[Column]:
    """The digits of a code of so many bits, least first, evenly wide."""
    if bits == 0:
        return []
    width = -(-bits // -(-bits // DIGIT_BITS))
    mask = F.lit((1 << width) - 1).cast("bigint")
    return [
        F.shiftrightunsigned(code, shift).bitwiseAND(mask) for shift in range(0, bits, width)
    ]


def _key_digits(key: Column, descending: bool, least, most, nulls: int) -> list[Column]:
    """The digits of a BIGINT key whose values lie from ``least`` to ``most``;
    nulls come last in either direction."""
    found = []
    if least is not None:
        if most - least < 1 << 63:
            code = F.lit(most) - key if descending else key - F.lit(least)
            bits = (most - least).bit_length()
        else:
            code = key.bitwiseXOR(F.lit(_SIGN))
            code, bits = F.bitwise_not(code) if descending else code, 64
        found = _digits(F.coalesce(code, F.lit(0).cast("bigint")), bits)
    return found + ([key.isNull().cast("bigint")] if nulls else [])


def _moved(rows: DataFrame, digit: Column, block_bits: int, staging: Staging) -> DataFrame:
    """One stable counting pass: (row, at) with the places after it."""
    cut = rows.select("row", "at", digit.alias("digit"), F.shiftright("at", block_bits).alias("block"))
    counts = staging.save(
        cut.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    # A row per digit, of which there are at most 2 ** DIGIT_BITS.
    lower = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        counts.groupBy("digit")
        .agg(F.sum("n").alias("n"))
        .select("digit", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("first"))
    )
    earlier = (
        Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.join(F.broadcast(firsts), "digit").select(
        "digit",
        "block",
        (F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("offset"),
    )
    rank = F.row_number().over(Window.partitionBy("digit", "block").orderBy("at")) - 1
    return (
        cut.withColumn("rank", rank)
        .join(offsets, ["digit", "block"])
        .select("row", (F.col("offset") + F.col("rank")).alias("at"))
    )


def radix_sorted(
    rows: DataFrame, order: Sequence[tuple[str, bool]], position: str
) -> DataFrame:
    """``rows`` with one more column ``position``, their 0-based places in an
    order of BIGINT columns, (name, descending) each, the most significant
    first. Nulls come last. Rows with equal keys keep the order in which they
    were written. Returns a staged table; an empty one stays empty."""
    spark = rows.sparkSession
    held = Staging(spark)
    packed = F.struct(*[F.col(quoted(c)) for c in rows.columns]).alias("row")
    placed = held.save(rows.select(packed, F.monotonically_increasing_id().alias("at")), "rows")
    keys = [(F.col("row").getField(name), down) for name, down in order]
    bounds = placed.agg(
        F.count(F.lit(1)),
        *[x for key, _ in keys for x in (F.min(key), F.max(key), F.count_if(key.isNull()))],
    ).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bits = (bounds[0] // (4 * partitions)).bit_length()
    block_bits = min(BLOCK_BITS, max(LEAST_BLOCK_BITS, block_bits))
    # The first places have gaps between files; a pass without effect closes them.
    digits = [F.lit(0).cast("bigint")]
    for i, (key, down) in reversed(list(enumerate(keys))):
        digits += _key_digits(key, down, *bounds[1 + 3 * i : 4 + 3 * i])
    for digit in digits[1:] or digits:
        after = Staging(spark)
        placed = after.save(_moved(placed, digit, block_bits, after), "rows")
        held.drop()
        held = after
    names = [F.col("row").getField(c).alias(c) for c in rows.columns if c != position]
    return placed.select(*names, F.col("at").alias(position))
