"""Quality rules with risk-controlled cutoffs (operator 13).

Four rules reject a document whose share of symbols, of repeated words or of
repeated lines, or whose mean length of words, reaches a cutoff. Cutoffs come
from labelled documents, for every stratum apart: a cutoff is certified if the
exact binomial test on the stratum's good documents excludes that it falsely
rejects more than its part of the allowed share. All certificates hold together
with the stated confidence: the rules of a stratum divide the allowed share, so
that their union keeps it, and the risk is divided by the number of tests
(strata x rules, Bonferroni). Within one rule the cutoffs are tested from the
loosest to the tightest, up to the first that fails, which costs no correction.

Of the certified cutoffs a rule takes the one with the largest surplus of
rejected bad over rejected good documents, the loosest of equals; without a
surplus the rule rejects nothing in that stratum.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.lookup import broadcast_if_small
from starmart.staging import Staging

# What separates words, what counts as a symbol, the base rules.
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
FALSE_REJECTION = 0.05
RISK = 0.05
# Levels of a signal; the highest one stands for all above.
LEVELS = 1_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    """Rejects from a level of ``scale * part / whole`` on."""

    name: str
    part: str
    whole: str
    scale: int

    def level(self) -> Column:
        whole = F.greatest(F.col(self.whole), F.lit(1))
        ratio = F.floor(F.col(self.part) * self.scale / whole)
        return F.least(ratio, F.lit(LEVELS)).cast("bigint")


RULES = (
    Rule("symbols", "n_symbols", "n_words", 100),
    Rule("repeats", "n_repeat_words", "n_words", 100),
    Rule("lines", "n_dup_lines", "n_lines", 100),
    Rule("long_words", "word_chars", "n_words", 50),
)


def repeat_words(words: Sequence[bytes]) -> int:
    """Words in a run of three that occurs twice or more, the first included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, runs, times = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    again = times[runs] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(again) + i] |= again
    return int(covered.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """MEASURES of a whole text; zeros for None."""
    if not text:
        return (0,) * len(MEASURES)
    # bytes.split() knows exactly the BLANKS.
    words = text.encode("utf-8", "surrogatepass").split()
    met: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            again += line in met
            met.add(line)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        lines,
        again,
        repeat_words(words),
    )


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang"
) -> DataFrame:
    """(id, stratum, MEASURES, base_failed) of every row of ``docs``."""

    @F.pandas_udf(", ".join(f"{m} BIGINT" for m in MEASURES))
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [measured(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame(rows, columns=MEASURES, dtype="int64")

    found = docs.select(
        F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"), of(text_col).alias("of")
    )
    failed = (F.col("of.n_words") < LEAST_WORDS) | (
        100 * F.col("of.n_repeat_words") > MOST_REPEATED_PERCENT * F.col("of.n_words")
    )
    return found.select("id", "stratum", "of.*", failed.alias("base_failed"))


def allowed_rejections(n: int, share: float, risk: float) -> int:
    """The largest k with P(X <= k) <= risk for X ~ Binomial(n, share): with k or
    fewer of n rejected, the exact test excludes a share above ``share``. -1 if
    even none rejected is not enough evidence."""
    # Below this the probabilities sum to nothing that a double can show.
    low = max(0, math.floor(n * share - 40 * math.sqrt(n * share) - 40))
    first = (
        math.lgamma(n + 1) - math.lgamma(low + 1) - math.lgamma(n - low + 1)
        + low * math.log(share) + (n - low) * math.log1p(-share)
    )
    i = np.arange(low, math.ceil(n * share) + 1)
    steps = np.log((n - i[:-1]) / (i[:-1] + 1)) + math.log(share) - math.log1p(-share)
    logs = first + np.concatenate([[0.0], np.cumsum(steps)])
    within = int((np.cumsum(np.exp(logs)) <= risk).sum())
    return low + within - 1


def certified_cutoffs(
    signals: DataFrame,
    labels: DataFrame,
    staging: Staging,
    id_col: str = "doc_id",
    quality_col: str = "quality",
    false_rejection: float = FALSE_REJECTION,
    risk: float = RISK,
) -> DataFrame:
    """(stratum, rule, cutoff, n_good, allowed): what each rule rejects from.

    Uses all documents with a label that pass the base rules; quality 0 is bad,
    any other good. An id counts once however often it is there, with its
    highest levels, its least stratum and its least label; null ids and null
    labels do not count. A null stratum is a stratum like others. What leaves
    the joins of narrow rows are counts by stratum, rule and level.
    """
    named = F.col("id").isNotNull() & ~F.col("base_failed")
    docs = (
        signals.where(named)
        .groupBy("id")
        .agg(
            F.min("stratum").alias("stratum"),
            *[F.max(r.level()).alias(r.name) for r in RULES],
        )
    )
    marks = (
        labels.select(F.col(id_col).alias("id"), F.col(quality_col).alias("quality"))
        .where("id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("id")
        .agg((F.min("quality") != 0).alias("good"))
    )
    counts = (
        docs.join(marks, "id")
        .unpivot(["stratum", "good"], [r.name for r in RULES], "rule", "level")
        .groupBy("stratum", "rule", "level")
        .agg(F.sum(F.col("good").cast("bigint")).alias("good"), F.count(F.lit(1)).alias("n"))
    )
    counts = staging.save(counts, "levels")
    tests = len(RULES) * max(1, counts.select("stratum").distinct().count())
    share = false_rejection / len(RULES)

    @F.pandas_udf("bigint")
    def allowed(sizes: pd.Series) -> pd.Series:
        return pd.Series([allowed_rejections(int(n), share, risk / tests) for n in sizes], dtype="int64")

    group = Window.partitionBy("stratum", "rule")
    above = group.orderBy(F.col("level").desc())
    best = group.orderBy(F.col("surplus").desc(), F.col("level").desc())
    return (
        counts.select(
            "stratum",
            "rule",
            "level",
            F.sum("good").over(group).alias("n_good"),
            F.sum("good").over(above).alias("good"),
            F.sum(F.col("n") - F.col("good")).over(above).alias("bad"),
        )
        .withColumn("allowed", allowed("n_good"))
        .withColumn("surplus", F.col("bad") - F.col("good"))
        .where("level > 0 AND surplus > 0 AND good <= allowed")
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("stratum", "rule", F.col("level").alias("cutoff"), "n_good", "allowed")
    )


def _stratum_key(stratum: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit(""))


def judged(signals: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``signals`` with failed_rules (names joined by commas, in the order of
    RULES) and kept. A base failure is not kept whatever the rules say."""
    by_stratum = cutoffs.groupBy(_stratum_key(F.col("stratum")).alias("key")).agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"from_{r.name}") for r in RULES]
    )
    failed = F.concat_ws(
        ",", *[F.when(r.level() >= F.col(f"from_{r.name}"), F.lit(r.name)) for r in RULES]
    )
    return (
        signals.withColumn("key", _stratum_key(F.col("stratum")))
        .join(broadcast_if_small(by_stratum), "key", "left")
        .select(*signals.columns, failed.alias("failed_rules"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
    )


def quality_filter(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    staging: Staging | None = None,
) -> DataFrame:
    """(id, stratum, MEASURES, base_failed, failed_rules, kept) of every row.

    Texts are read once, into a staged narrow table. Null and empty texts have
    no words and fail the base rules; strata without labels, or with too few for
    a certificate, lose nothing beyond the base rules.
    """
    staging = staging or Staging(docs.sparkSession)
    signals = staging.save(measure(docs, id_col, text_col, stratum_col), "signals")
    cutoffs = staging.save(certified_cutoffs(signals, labels, staging, id_col), "cutoffs")
    return judged(signals, cutoffs)
