"""Resampling, radix sort, whitening and quality rules against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from conftest import odd_documents, prose
from pyspark.sql import functions as F

from starmart.llm import quality, radix, resampling, whitening
from starmart.staging import Staging

# --- radix sort -----------------------------------------------------------


@pytest.mark.parametrize("reach", [0, 3, 5_000, (1 << 63) - 1])
def test_radix_sort_equals_a_stable_sort(spark, reach):
    rng = random.Random(reach)
    value = lambda: None if rng.random() < 0.1 else rng.randint(-reach - (reach > 5_000), reach)
    rows = [(i, value(), value()) for i in range(3_000)]
    df = spark.createDataFrame(rows, "i BIGINT, row BIGINT, at BIGINT").repartition(7)
    found = radix.radix_sorted(df, [("row", True), ("at", False)], "place").collect()
    assert sorted(r["place"] for r in found) == list(range(len(rows)))
    by_place = [(r["row"], r["at"]) for r in sorted(found, key=lambda r: r["place"])]
    key = lambda p: (p[0] is None, -(p[0] or 0), p[1] is None, p[1] or 0)
    assert by_place == sorted(((r[1], r[2]) for r in rows), key=key)


def test_radix_sort_is_stable_and_takes_no_rows(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("k")).coalesce(1)
    found = radix.radix_sorted(df, [("k", False)], "place").orderBy("place").collect()
    assert [r["id"] for r in found] == sorted(range(500), key=lambda i: i % 3)
    assert radix.radix_sorted(df.limit(0), [("k", False)], "place").count() == 0


def test_radix_blocks_bound_a_hot_digit(spark):
    """All rows have one digit; no group of the ranking exceeds a block."""
    rows = spark.range(20_000).select(F.struct("id").alias("row"), F.col("id").alias("at"))
    cut = rows.select(F.shiftright("at", 8).alias("block")).groupBy("block").count()
    assert cut.agg(F.max("count")).first()[0] == 256
    moved = radix._moved(rows, F.lit(5).cast("bigint"), 8, Staging(spark))
    assert moved.where("row.id = at").count() == 20_000


# --- resampling -----------------------------------------------------------


def _features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _resampled(docs, target):
    count = lambda texts: np.bincount(
        [crc32(f.encode()) % 10_000 for t in texts for f in _features(t)[1]], minlength=10_000
    ).tolist()
    s, t = count([x[1] for x in docs]), count(target)
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000))))
        for a, b in zip(s, t, strict=True)
    ]
    rows = []
    for i, text in docs:
        words, features = _features(text)
        total = sum(gain[crc32(f.encode()) % 10_000] for f in features)
        weight = total // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words), len(features), weight, score, None])
    ranked = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(ranked[: 25 * len(ranked) // 100]):
        r[5] = place + 1
    return sorted(map(str, rows))


def test_resampling_equals_brute_force(spark):
    docs = odd_documents() + [(i, prose(i, 15 + i % 30)) for i in range(100, 260)]
    docs += [(101, prose(101, 26)), (300, "A1 b2_C3-d4 ÀÉ é́ " * 12), (301, "@[`{\x7f/:" * 30)]
    target = [prose(5, 40), None, "", "A1 b2 c3"]
    rows = [(i, t, 1, 2, "r") for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, id INT, score INT, rank STRING")
    goal = spark.createDataFrame([(t, 1) for t in target], "text STRING, bucket INT")
    found = resampling.resample(df.repartition(5), goal)
    assert found.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(str(list(r)) for r in found.collect()) == _resampled(docs, target)


def test_resampling_of_empty_tables(spark, no_docs, odd_docs):
    assert resampling.resample(no_docs, no_docs).count() == 0
    assert resampling.resample(odd_docs, no_docs).count() == len(odd_documents())


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = prose(1, 500)
    buckets = lambda: sorted(np.concatenate([b for _, b in resampling.feature_buckets(text)]))
    whole = buckets()
    for piece in (1, 7, 100):
        monkeypatch.setattr(resampling, "PIECE", piece)
        assert buckets() == whole


# --- whitening ------------------------------------------------------------


def _vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    spread = np.diag(np.linspace(2, 0.2, width)) @ np.linalg.qr(rng.normal(size=(width, width)))[0]
    return rng.normal(size=(n, width)) @ spread + rng.normal(size=width)


def _whitened(vectors, wanted=4):
    x = np.floor(256 * np.asarray(vectors))
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    off = fit - sums / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    values, axes = values[::-1], axes[:, ::-1][:, :wanted]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return n, deviation, (x - sums / n) @ axes / np.sqrt(values[:wanted]), values[:wanted] / values.sum()


@pytest.mark.parametrize("width", [2, 24, 60])
def test_whitening_equals_eigenvectors(spark, width):
    vectors = _vectors(400, width).tolist()
    vectors += vectors[:50]
    rows = [(i, v, "x", 1) for i, v in enumerate(vectors)]
    rows += [(None, vectors[0], "x", 1), (900, None, "x", 1), (901, [], "x", 1)]
    rows += [(902, [None] * width, "x", 1), (903, [float("nan")] * width, "x", 1)]
    rows += [(904, [float("-inf")] * width, "x", 1), (905, [0.0], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, id STRING, x INT")
    found = whitening.whiten(df.repartition(3)).collect()
    n, deviation, expected, explained = _whitened(vectors)
    k = min(4, width)
    assert len(found) == 451 * k and {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    got = np.zeros((len(vectors), k))
    for r in found:
        if r["id"] is not None:
            got[r["id"], r["component"] - 1] = r["whitened"]
            assert r["deviation"] == deviation[r["id"]]
            assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-8


def test_whitening_without_variance_or_rows(spark):
    kind = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], kind)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [i / 8, -i / 8, 0.0]) for i in range(9)], kind)
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9
    assert abs(found[0]["explained"] - 1) < 1e-12


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[1 << 20, -(1 << 21)], [3, 7]])
    n, sums = 1001, [12_345, -77]
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert whitening._deviation(x, n, sums)[1] == exact
    far = np.array([[1 << 40, 5]])
    assert whitening._deviation(far, 1 << 30, sums)[1] == [None]


def test_filter_needs_few_products_and_certifies():
    values = np.concatenate([[9.0, 5.0, 4.0, 3.9], np.linspace(3.5, 0.1, 196)])
    axes = np.linalg.qr(np.random.default_rng(1).normal(size=(200, 200)))[0]
    matrix, calls = (axes * values) @ axes.T, []

    def product(q):
        calls.append(q.shape[1])
        return matrix @ q

    found, vectors = whitening.leading_eigenpairs(product, 200, 4)
    assert np.abs(found - values[:4]).max() < 1e-12
    assert np.abs(np.abs((vectors * axes[:, :4]).sum(axis=0)) - 1).max() < 1e-12
    assert max(calls) == whitening.BLOCK and len(calls) < 120


# --- quality --------------------------------------------------------------


def _measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, run in enumerate(runs) if runs.count(run) > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_measures_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1_500):
        text = "".join(rng.choice("aab é#|<\n\n \t\x0b\x0c\r\x1c ") for _ in range(rng.randint(0, 60)))
        assert quality.measured(text) == _measured(text), repr(text)


def test_allowed_rejections_are_the_exact_binomial_bound():
    for n, share, risk in [(10, 0.3, 0.1), (200, 0.0125, 0.1), (300, 0.0125, 0.01), (2_000, 0.02, 0.003)]:
        k, total, p = -1, Fraction(0), Fraction(share)
        while (total := total + math.comb(n, k + 1) * p ** (k + 1) * (1 - p) ** (n - k - 1)) <= risk:
            k += 1
        assert quality.allowed_rejections(n, share, risk) == k
    assert quality.allowed_rejections(0, 0.1, 0.01) == -1
    # 12.8 standard deviations below the mean at most, and close to the normal bound.
    large = quality.allowed_rejections(10**9, 0.0125, 0.003)
    assert abs((12.5e6 - large) / math.sqrt(12.5e6 * 0.9875) - 2.748) < 0.01


def _labelled(spark, n_good, n_bad):
    """Bad documents carry symbols; strata x (labelled) and y (few labels)."""
    rows, labels = [], []
    for i in range(n_good + n_bad):
        good = i < n_good
        words = prose(i, 60).split()
        if not good:
            words = [w + "%%" for w in words]
        rows.append((i, " ".join(words), "x", "k"))
        labels.append((i, int(good)))
    rows += [(10**6, " ".join(w + "%%" for w in prose(1, 60).split()), "y", "k")]
    rows += [(10**6 + 1, prose(2, 60), None, "k"), (10**6 + 2, "few words", "x", "k")]
    rows += [(10**6 + 3, " ".join(w + "%%" for w in prose(7, 60).split()), "x", "k")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, key STRING")
    return docs, spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id BIGINT, quality INT")


def test_cutoffs_are_certified_or_not_used(spark):
    docs, labels = _labelled(spark, 500, 20)
    found = {r["id"]: r for r in quality.quality_filter(docs, labels).collect()}
    assert all(found[i]["kept"] for i in range(500))
    assert not any(found[i]["kept"] for i in range(500, 520))
    assert found[510]["failed_rules"].split(",")[0] == "symbols"
    assert found[10**6]["kept"], "a stratum without labels keeps what passes the base rules"
    assert found[10**6 + 1]["kept"] and not found[10**6 + 2]["kept"]
    assert not found[10**6 + 3]["kept"]
    docs, labels = _labelled(spark, 150, 20)  # too few for a certificate
    found = quality.quality_filter(docs, labels).where("NOT base_failed")
    assert found.where("NOT kept").count() == 0


def test_false_rejections_bound_the_cutoff(spark):
    """A rule takes the loosest of its best cutoffs, and none beyond the bound."""
    rows = [(i, i % 100 < 3, 900 + i % 7) for i in range(3_000)]  # 3 % of the good share the signal
    signals = spark.createDataFrame(
        [(i, "x", 100, 500, 300 if hot else 0, 1, 0, 0, False) for i, hot, _ in rows]
        + [(9_000 + i, "x", 100, 500, 300, 1, 0, 0, False) for i in range(500)],
        "id BIGINT, stratum STRING, " + ", ".join(f"{m} BIGINT" for m in quality.MEASURES)
        + ", base_failed BOOLEAN",
    )
    labels = spark.createDataFrame(
        [(i, 1) for i, _, _ in rows] + [(9_000 + i, 0) for i in range(500)], "doc_id BIGINT, quality INT"
    )
    strict = quality.certified_cutoffs(signals, labels, Staging(spark))
    assert strict.count() == 0, "3 % exceed the 1.25 % that a rule may reject"
    loose = quality.certified_cutoffs(signals, labels, Staging(spark), false_rejection=0.2).collect()
    assert [(r["rule"], r["cutoff"], r["n_good"]) for r in loose] == [("symbols", 300, 3_000)]


def test_odd_rows_of_quality(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, None)], "doc_id BIGINT, quality INT")
    found = quality.quality_filter(odd_docs, labels, stratum_col="key").collect()
    assert len(found) == len(odd_documents())
    want = {(i, _measured(t)) for i, t in odd_documents() if t is None or len(t) < 10_000}
    assert want <= {(r["id"], tuple(r[m] for m in quality.MEASURES)) for r in found}
    assert quality.quality_filter(no_docs, labels.limit(0)).count() == 0
