"""Resampling towards a target distribution (operator 11).

Texts become bags of hashed one- and two-word features. How much more frequent
a bucket is in the target texts than in all documents is its gain; a document's
weight is the mean gain of its features, read from an array that every task
holds. Scores are weights plus Gumbel noise that depends on the id alone, so the
highest scores are a draw without replacement by importance. A distributed radix
sort ranks them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.radix import radix_sorted
from starmart.staging import Staging

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
DRAWN_PERCENT = 25
# Words of so many bytes of a text are split at a time.
PIECE = 1 << 20
# A-Z become a-z; a-z, 0-9 and all bytes of other characters stay; the rest separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def feature_buckets(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of their features) for each piece of a text: every word
    by itself, and with the word before it."""
    folded = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    before: list[int] = []
    begin = 0
    while begin < len(folded):
        end = folded.find(b" ", begin + PIECE)
        end = len(folded) if end < 0 else end
        words = folded[begin:end].split()
        begin = end
        if not words:
            continue
        ones = list(map(crc32, words))
        before += ones[:-1]
        # A checksum goes on from that of the word before.
        seconds = [b" " + w for w in words[len(words) - len(before) :]]
        twos = list(map(crc32, seconds, before))
        before = ones[-1:]
        yield len(words), np.array(ones + twos, np.int64) % BUCKETS


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket. Every task sends one count per bucket."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for part in parts:
            for text in part["text"]:
                for _, buckets in feature_buckets(text):
                    total += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .where("text IS NOT NULL")
        .mapInPandas(count, "bucket BIGINT, n BIGINT")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    found = np.zeros(BUCKETS, np.int64)
    for r in rows:
        found[r["bucket"]] = r["n"]
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the target's smoothed share over the source's."""
    whole_source, whole_target = float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(
                1000
                * math.log(
                    (t + 1.0) * (whole_source + BUCKETS) / ((s + 1.0) * (whole_target + BUCKETS))
                )
            )
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable that follows from the id; a null id
    counts as an empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row. Null texts and
    texts without words weigh 0."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(text: str | None) -> tuple[int, int, int]:
        n_words = n_features = total = 0
        for words, buckets in feature_buckets(text):
            n_words += words
            n_features += len(buckets)
            total += int(shared.value[buckets].sum())
        return n_words, n_features, total // n_features if n_features else 0

    @F.pandas_udf("n_words BIGINT, n_features BIGINT, weight BIGINT")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [weigh(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype="int64")

    found = docs.select(F.col(id_col).alias("id"), of(text_col).alias("of"))
    return found.select("id", "of.*").withColumn("score", F.col("weight") + noise(F.col("id"), seed))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    staging: Staging | None = None,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``docs``.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred
    (rounded down) with the highest scores have a rank, from 1; of equal scores
    the smaller id comes first, a null id last. Ids are BIGINTs. Rows that repeat
    an id are rows of their own; with equal scores they keep the order in which
    they were written. An empty target makes every gain follow from the documents alone.
    """
    staging = staging or Staging(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = staging.save(scored(docs, gains, id_col, text_col, seed), "scores")
    long_enough = F.col("n_words") >= least_words
    ranked = radix_sorted(rows.where(long_enough), [("score", True), ("id", False)], "place")
    drawn = rows.where(long_enough).count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    others = rows.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", rank).drop("place").unionByName(others)
