"""Near-duplicates by consistent weighted sampling (operator 1).

A document is its multiset of five-word shingles. A shingle weighs its count
times the mean inverse document frequency of its words. Improved consistent
weighted sampling draws ``ROWS * BANDS`` samples per text; two texts draw the
same sample with a probability equal to their weighted Jaccard similarity.
Texts that agree in all samples of a band meet in a bucket, and every link that
counts is verified by the exact weighted Jaccard similarity of the two texts.

Word frequencies count all documents. They are held in ``WORD_BUCKETS`` hashed
counters, a table of fixed size whatever the corpus, so its broadcast is bounded.
Frequencies of words, not of shingles, keep a large group of copies similar: a
shingle that many copies share does not lose its weight against their edits.

Buckets are never expanded into all pairs. First each bucket compares its leader,
the member that meets most others over all bands, with the rest; a large group of
copies mostly ends up in the leader's class that way. Then a member outside the
leader's class meets members of other classes of its bucket, but only those that
can be similar. Two exact bounds tell: the distance (1 - similarity) is a metric,
so their distances to the leader may differ by ``1 - SIMILARITY`` at most; and
texts share no more weight than their shingles hashed into ``BINS`` bins do. All
pairs left are verified, in rounds, unless an earlier round put them in a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.components import component_labels
from starmart.llm.text import batches, mix, shingles_of, signed, words_of
from starmart.staging import Staging

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 10
ROWS = 4
WORD_BUCKETS = 1 << 18
# Bins of weights per text, and members of a bucket that one task compares.
BINS = 256
BLOCK = 256
PAIRS_AT_ONCE = 4_096
# Partners of a text verified in the first round, and their growth per round.
FIRST_PARTNERS = 4
MORE_PARTNERS = 8
# Shingles, in whole sets, that a verifying task keeps: 12 bytes each.
KEPT_SHINGLES = 2_000_000
# Texts handled at once, in characters.
BATCH_CHARS = 1 << 18

_BUCKET_SHIFT = np.uint64(64 - 18)
_DRAW_BITS = 16
_OFFSET = np.float32(64)


def _draws(samples: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per sample an odd multiplier; per multiplied hash the variables r, 1/r,
    beta and ln c of the sampling: two Gamma(2, 1) and a uniform."""
    rng = np.random.Generator(np.random.PCG64(seed))
    odd = rng.integers(0, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
    u = rng.random((1 << _DRAW_BITS, 5)) * (1 - 1e-9) + 1e-9
    r, c = -np.log(u[:, 0] * u[:, 1]), -np.log(u[:, 2] * u[:, 3])
    return odd, [x.astype(np.float32) for x in (r, 1 / r, u[:, 4], np.log(c) - r)]


def word_buckets(words: np.ndarray) -> np.ndarray:
    return (words >> _BUCKET_SHIFT).astype(np.int64)


def word_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents per word bucket, and documents. Each task adds its own counts
    up; what reaches the driver are ``WORD_BUCKETS`` rows at most."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(WORD_BUCKETS + 1, np.int64)
        for part in parts:
            texts = part[text].tolist()
            for run in batches([len(t or "") for t in texts], BATCH_CHARS):
                words, first = words_of(texts[run])
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
                pairs = np.unique(owner * WORD_BUCKETS + word_buckets(words))
                total[:-1] += np.bincount(pairs % WORD_BUCKETS, minlength=WORD_BUCKETS)
                total[-1] += len(first) - 1
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = (
        docs.select(text)
        .mapInPandas(count, "bucket BIGINT, n BIGINT")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    total = np.zeros(WORD_BUCKETS + 1, np.int64)
    total[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return total[:-1], int(total[-1])


def inverse_frequencies(counts: np.ndarray, documents: int) -> np.ndarray:
    return (1 + np.log((documents + 1) / (counts + 1))).astype(np.float32)


def weighted_shingles(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and their weights."""
    if len(words) == 0:
        return words, np.zeros(0, np.float32)
    hashes = shingles_of(words, SHINGLE_WORDS)
    each = idf[word_buckets(words)]
    size = min(SHINGLE_WORDS, len(words))
    mean = np.zeros(len(hashes), np.float32)
    for i in range(size):
        mean += each[i : i + len(hashes)]
    kept, at, n = np.unique(hashes, return_index=True, return_counts=True)
    return kept, n.astype(np.float32) * mean[at] / np.float32(size)


def weighted_jaccard(a, b) -> float:
    """Of two results of ``weighted_shingles``."""
    (ha, wa), (hb, wb) = a, b
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = float(np.minimum(wa[ia], wb[ib]).sum(dtype=np.float64))
    either = float(wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64)) - both
    return both / either if either > 0 else 0.0


def samples_of(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray, draws) -> np.ndarray:
    """(samples, texts) names of the samples drawn. ``first``: where the shingles
    of each text begin; every text has one at least."""
    odd, (r, inverse, beta, log_c) = draws
    log_weight = np.log(weights)
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    samples = np.empty((len(odd), len(first)), np.uint64)
    for k, factor in enumerate(odd):
        drawn = ((hashes * factor) >> np.uint64(64 - _DRAW_BITS)).astype(np.intp)
        place = beta[drawn]
        step = log_weight * inverse[drawn]
        step += place
        np.floor(step, out=step)
        # ln a = ln c - r * (step - beta) - r, shifted to be positive
        place -= step
        place *= r[drawn]
        place += log_c[drawn]
        place += _OFFSET
        np.maximum(place, np.float32(0), out=place)
        name = low + step.astype(np.int32).view(np.uint32) * np.uint32(0x85EBCA6B)
        key = (place.view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
        samples[k] = np.minimum.reduceat(key, first)
    return samples & np.uint64(0xFFFFFFFF)


def band_hashes(names: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of the samples of each band."""
    out = np.empty((names.shape[1], BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(names.shape[1], band, np.uint64)
        for row in names[band * ROWS : (band + 1) * ROWS]:
            h = mix(h ^ mix(row + np.uint64(band)))
        out[:, band] = h
    return out


def _sampled(texts: list[str | None], idf: np.ndarray, draws) -> Iterator[np.ndarray | None]:
    """Per text its samples, None without words."""
    for run in batches([len(t or "") for t in texts], BATCH_CHARS):
        words, first = words_of(texts[run])
        sets = [
            weighted_shingles(words[a:b], idf) for a, b in zip(first[:-1], first[1:], strict=True)
        ]
        full = [s for s in sets if len(s[0])]
        names = iter(())
        if full:
            starts = np.cumsum([0] + [len(s[0]) for s in full[:-1]])
            joined = [np.concatenate(x) for x in zip(*full, strict=True)]
            names = iter(samples_of(*joined, starts, draws).T)
        for s in sets:
            yield next(names) if len(s[0]) else None


def _signatures(keyed: DataFrame, idf: Broadcast) -> DataFrame:
    """(id, text_key, bands); bands are empty for a text without words."""

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draws = _draws(BANDS * ROWS, 20)
        for part in parts:
            names = list(_sampled(part["text"].tolist(), idf.value, draws))
            full = [n for n in names if n is not None]
            hashes = iter(signed(band_hashes(np.stack(full, axis=1))) if full else ())
            bands = [[] if n is None else next(hashes) for n in names]
            yield part[["id", "text_key"]].assign(bands=bands)

    return keyed.mapInPandas(sign, "id BIGINT, text_key BINARY, bands ARRAY<BIGINT>")


def profile(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights of a text's shingles summed in BINS bins."""
    bins = (mix(hashes) % np.uint64(BINS)).astype(np.int64)
    return np.bincount(bins, weights, BINS).astype(np.float32)


def possible(profiles: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs of profiles may be of texts with SIMILARITY: what two bins
    share is the most that their shingles share. Allows for rounding."""
    total = profiles.sum(axis=1, dtype=np.float64)
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), PAIRS_AT_ONCE):
        x, y = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
        both = np.minimum(profiles[x], profiles[y]).sum(axis=1, dtype=np.float64)
        out[at : at + PAIRS_AT_ONCE] = both >= (SIMILARITY - 1e-4) * (total[x] + total[y] - both)
    return out


def _profiles(texts: DataFrame, idf: Broadcast) -> DataFrame:
    """(text_key, profile) of texts with words."""

    def bins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for text in part["text"]:
                found.append(profile(*weighted_shingles(words_of([text])[0], idf.value)).tobytes())
            yield part[["text_key"]].assign(profile=found)

    return texts.mapInPandas(bins, "text_key BINARY, profile BINARY")


def _verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """(a, b, sim): the exact weighted Jaccard similarity of each pair."""

    def verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def shingles(key: bytes, text: str):
            nonlocal held
            if key not in kept:
                if held >= KEPT_SHINGLES:
                    kept.clear()
                    held = 0
                kept[key] = weighted_shingles(words_of([text])[0], idf.value)
                held += len(kept[key][0])
            return kept[key]

        for part in parts:
            rows = zip(part["a"], part["b"], part["a_text"], part["b_text"], strict=True)
            found = [weighted_jaccard(shingles(a, x), shingles(b, y)) for a, b, x, y in rows]
            yield part[["a", "b"]].assign(sim=found)

    left = texts.select(F.col("text_key").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("text_key").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return both.mapInPandas(verify, "a BINARY, b BINARY, sim DOUBLE")


def _beyond_leaders(
    state: DataFrame, led: DataFrame, labels: DataFrame, texts: DataFrame, idf: Broadcast,
    staging: Staging,
) -> DataFrame:
    """(a, b): pairs of members of a bucket in two classes, one of them outside
    the leader's, that the leader's distances and the profiles leave possible."""
    label = lambda of, name: labels.select(F.col("node").alias(of), F.col("label").alias(name))
    low, high = F.least("text_key", "leader"), F.greatest("text_key", "leader")
    placed = (
        state.withColumn("a", low)
        .withColumn("b", high)
        .join(led, ["a", "b"])
        .join(label("text_key", "own"), "text_key", "left")
        .join(label("leader", "first"), "leader", "left")
        .select(
            "bucket",
            "text_key",
            "sim",
            F.coalesce("own", "text_key").alias("own"),
            F.coalesce("own", "text_key").eqNullSafe(F.coalesce("first", "leader")).alias("inside"),
        )
    )
    dealt = _dealt(staging.save(placed, "placed"))
    dealt = staging.save(dealt, "dealt")
    profiles = _profiles(texts.join(dealt.select("text_key").distinct(), "text_key"), idf)
    met = (
        dealt.join(profiles, "text_key")
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        .withColumn("low", F.least("block", "with"))
        .withColumn("high", F.greatest("block", "with"))
        .select("bucket", "low", "high", "block", "text_key", "sim", "own", "inside", "profile")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
    )

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            keys = held[["bucket", "low", "high"]].to_numpy()
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(new):  # the last one may go on
                yield _possible_pairs(held[: new[-1]], np.append(0, new))
                held = held[new[-1] :].reset_index(drop=True)
        if held is not None and len(held):
            yield _possible_pairs(held, np.array([0, len(held)]))

    return (
        met.mapInPandas(compare, "a BINARY, b BINARY")
        .distinct()
        .join(led.select("a", "b"), ["a", "b"], "left_anti")
    )


def _dealt(placed: DataFrame) -> DataFrame:
    """Members of the buckets that have some outside the leader's class, with the
    block of each and the number of blocks that it meets.

    A bucket is compared block by block. Those left over meet all blocks. Those
    inside meet the blocks of the left-over ones alone, as pairs of two inside need
    nothing, and only if their distance to the leader is near that of one left
    over: the others no bound leaves possible. So what is sent grows with the
    left-over members, and a bucket of a single class is not looked at again.
    """
    reach = 1 - SIMILARITY + 1e-9
    left = placed.where("NOT inside").groupBy("bucket").agg(
        F.min("sim").alias("least"), F.max("sim").alias("most")
    )
    near = ~F.col("inside") | (
        (F.col("sim") >= F.col("least") - reach) & (F.col("sim") <= F.col("most") + reach)
    )
    kept = placed.join(left, "bucket").where(near)
    blocks = lambda of: F.ceil(F.count_if(of) / F.lit(BLOCK)).cast("int")
    sizes = kept.groupBy("bucket").agg(
        blocks(~F.col("inside")).alias("outer"), blocks(F.col("inside")).alias("inner")
    )
    place = F.xxhash64("text_key")
    return kept.join(sizes, "bucket").select(
        "bucket", "text_key", "sim", "own", "inside",
        F.when(F.col("inside"), F.col("outer") + F.pmod(place, "inner"))
        .otherwise(F.pmod(place, "outer")).cast("int").alias("block"),
        F.when(F.col("inside"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")).alias("others"),
    )


def _possible_pairs(rows: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
    """(a, b) in each run of rows between two bounds: members of two blocks."""
    found = []
    columns = [rows[c].to_numpy() for c in ("low", "high", "block", "text_key", "sim", "own", "inside")]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - begin < 2:
            continue
        low, high, block, key, sim, own, inside = (c[begin:end] for c in columns)
        i, j = np.triu_indices(end - begin, 1)
        wanted = ~(inside[i] & inside[j]) & (np.abs(sim[i] - sim[j]) <= 1 - SIMILARITY + 1e-9)
        wanted &= np.unique(own, return_inverse=True)[1][i] != np.unique(own, return_inverse=True)[1][j]
        if low[0] != high[0]:
            wanted &= block[i] != block[j]
        i, j = i[wanted], j[wanted]
        if len(i):
            held = rows["profile"].iloc[begin:end]
            profiles = np.stack([np.frombuffer(p, np.float32) for p in held])
            able = possible(profiles, i, j)
            ends = ((key[x], key[y]) for x, y in zip(i[able], j[able], strict=True))
            found += [(min(x, y), max(x, y)) for x, y in ends]
    return pd.DataFrame(found, columns=["a", "b"])


def _in_rounds(
    pairs: DataFrame, linked: DataFrame, labels: DataFrame, texts: DataFrame, idf: Broadcast,
    staging: Staging,
) -> tuple[DataFrame, DataFrame]:
    """All links and their labels: a round verifies some partners of each text
    and drops the pairs that then share a class."""
    partners = FIRST_PARTNERS
    order = Window.partitionBy("a").orderBy(F.xxhash64("a", "b"), "b")
    while not pairs.isEmpty():
        ranked = staging.save(pairs.withColumn("nth", F.row_number().over(order)), "ranked")
        now = ranked.where(F.col("nth") <= partners).select("a", "b")
        found = staging.save(_verified(now, texts, idf), "more")
        linked = linked.unionByName(found.where(F.col("sim") >= SIMILARITY))
        labels = component_labels(linked, staging)
        label = lambda of: labels.select(F.col("node").alias(of), F.col("label").alias(f"{of}_label"))
        pairs = (
            ranked.where(F.col("nth") > partners)
            .join(label("a"), "a", "left")
            .join(label("b"), "b", "left")
            .where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b"))
            .select("a", "b")
        )
        pairs = staging.save(pairs, "pairs")
        partners *= MORE_PARTNERS
    return linked, labels


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", staging: Staging | None = None
) -> tuple[DataFrame, DataFrame]:
    """(members, links).

    members: one row per row of ``docs``: id, text_key, class_id (the smallest
    id of the class), class_key (a text_key that names the class), class_texts (distinct texts in it), n_verified_links (those of
    its links with other texts that were verified; a class needs not all). Equal texts share a class, whether
    linked or not. Null and blank texts have no shingles: each such row is a
    class of its own, with a null class_key. Rows that repeat an id count as rows of their own; a null
    id is kept, and a class whose ids are all null has a null class_id.

    links: a, b (text keys), sim.

    The jobs run at once; the results read staged tables.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    keyed = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("text_key"),
    )
    counts, total = word_frequencies(keyed, "text")
    idf = spark.sparkContext.broadcast(inverse_frequencies(counts, total))

    rows = staging.save(_signatures(keyed, idf), "signatures")
    worded = rows.where(F.size("bands") > 0)
    texts = staging.save(
        worded.groupBy("text_key").agg(
            F.min("id").alias("rep"),
            F.first("bands").alias("bands"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "texts",
    )
    met = texts.select("text_key", "rep", F.posexplode("bands").alias("band", "hash"))
    met = met.select("text_key", "rep", F.xxhash64("band", "hash").alias("bucket"))
    full = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    state = met.join(full, "bucket")
    fame = state.groupBy("text_key").agg(F.sum("n").alias("fame"))
    state = staging.save(state.join(fame, "text_key").select("bucket", "text_key", "fame"), "met")
    rank = F.struct("fame", F.hash("bucket", "text_key"), "text_key")
    leaders = state.groupBy("bucket").agg(F.max(rank).alias("top"))
    state = staging.save(
        state.join(leaders.select("bucket", F.col("top.text_key").alias("leader")), "bucket")
        .where("text_key <> leader")
        .select("bucket", "text_key", "leader"),
        "buckets",
    )
    wanted = state.select("text_key").unionAll(state.select("leader")).distinct()
    reps = texts.select("text_key", "rep").join(wanted, "text_key")
    needed = staging.save(
        keyed.join(
            reps.select(F.col("text_key").alias("k"), "rep"),
            (F.col("text_key") == F.col("k")) & F.col("id").eqNullSafe(F.col("rep")),
        )
        .select("text_key", "text")
        .dropDuplicates(["text_key"]),
        "needed",
    )

    low, high = F.least("text_key", "leader"), F.greatest("text_key", "leader")
    led = staging.save(
        _verified(state.select(low.alias("a"), high.alias("b")).distinct(), needed, idf), "led"
    )
    linked = led.where(F.col("sim") >= SIMILARITY)
    labels = component_labels(linked, staging)
    beyond = staging.save(_beyond_leaders(state, led, labels, needed, idf, staging), "pairs")
    links, labels = _in_rounds(beyond, linked, labels, needed, idf, staging)

    ends = links.select(F.col("a").alias("text_key")).unionAll(links.select("b"))
    degrees = ends.groupBy("text_key").agg(F.count(F.lit(1)).alias("n_verified_links"))
    named = texts.join(labels.withColumnRenamed("node", "text_key"), "text_key", "left").select(
        "text_key", "rep", "copies", F.coalesce("label", "text_key").alias("label")
    )
    classes = named.groupBy("label").agg(
        F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("class_texts")
    )
    per_text = named.join(classes, "label").join(degrees, "text_key", "left").drop("rep")
    per_text = staging.save(per_text, "per_text")
    # Texts with so many copies that one task would hold more than its part: at
    # most as many as there are partitions, so they can be broadcast.
    part = worded.count() // int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(per_text.where(F.col("copies") > max(1, part)))
    each = worded.select("id", "text_key")
    members = (
        each.join(hot, "text_key")
        .unionByName(each.join(hot.select("text_key"), "text_key", "left_anti").join(per_text, "text_key"))
        .select(
            "id",
            "text_key",
            "class_id",
            F.col("label").alias("class_key"),
            "class_texts",
            F.coalesce("n_verified_links", F.lit(0).cast("bigint")).alias("n_verified_links"),
        )
    )
    blank = rows.where(F.size("bands") == 0).select(
        "id",
        "text_key",
        F.col("id").alias("class_id"),
        F.lit(None).cast("binary").alias("class_key"),
        F.lit(1).cast("bigint").alias("class_texts"),
        F.lit(0).cast("bigint").alias("n_verified_links"),
    )
    return staging.save(members.unionByName(blank), "members"), links


def one_of_each(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay if each class keeps one: that with the
    smallest id, a null id only if all are null; of rows that repeat id and
    text, one. Rows without words all stay."""
    order = F.struct(F.col("id").isNull(), "id", "text_key")
    first = (
        members.where("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.min(order).alias("first"))
        .select("first.id", "first.text_key")
    )
    key = lambda i, t: F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("")), t))
    stays = first.select(key(F.col("id"), F.hex("text_key")).alias("stays"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    worded = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\S")), F.lit(False))
    # The row as one column, so that no name of its own clashes.
    keyed = docs.where(worded).select(
        F.struct("*").alias("row"), key(F.col(id_col), F.upper(F.md5(text))).alias("key")
    )
    kept = keyed.join(stays, F.col("key") == F.col("stays")).dropDuplicates(["key"])
    return kept.select("row.*").unionByName(docs.where(~worded))
