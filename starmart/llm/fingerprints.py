"""Document fingerprints: threshold-scaled sketches of shingles (operator 10).

A fingerprint keeps every five-word shingle whose hash lies below a fixed share
of the hash space. Whether a shingle is kept depends on its hash alone, so
sketches of parts merge by union, and shares of sketches estimate likeness and
containment also between very unequal documents. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.lookup import broadcast_if_small
from starmart.operators.numbering import POSITION, sorted_runs, with_position
from starmart.staging import Staging

SHINGLE_WORDS = 5
# Of 2 ** KEEP_BITS hashes one is kept.
KEEP_BITS = 2
# Of the order of ids, so that the partitions that hold them are about even.
BUCKETS_PER_PARTITION = 4
SKETCH = "array<bigint>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), 0)


def sketch(text: Column, keep_bits: int = KEEP_BITS) -> Column:
    """Sorted distinct hashes; empty for null texts and texts without words.
    ``keep_bits`` is 1 or more. A
    text of fewer words than a shingle is one shingle."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")

    def shingles(w: Column) -> Column:
        last = F.greatest(F.size(w) - SHINGLE_WORDS, F.lit(0))
        # get() beyond the end is null, which the hash passes over.
        every = F.transform(
            w,
            lambda _, i: F.when(
                i <= last, F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE_WORDS)])
            ),
        )
        return F.filter(every, lambda h: F.shiftrightunsigned(h, 64 - keep_bits) == 0)

    return F.array_sort(F.array_distinct(_let(F.transform(words, lambda w: F.xxhash64(w)), shingles)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts together."""
    return F.array_sort(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 0 if a is empty."""
    return F.when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda h: F.lower(F.hex(h))), " ")


def _bucket(bounds: Column, size: int, value: Column) -> Column:
    """The place of the last of so many ascending bounds that is not above the value."""

    def halved(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        below = F.get(bounds, middle) <= value
        return F.struct(
            F.when(below, middle).otherwise(at["low"]).alias("low"),
            F.when(below, at["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(size).alias("high"))
    steps = F.array_repeat(F.lit(0), max(1, size).bit_length())
    return F.aggregate(steps, start, halved, lambda at: at["low"])


def with_next(docs: DataFrame, id_col: str, text_col: str, staging: Staging) -> DataFrame:
    """(id, text, own, next_text, next_own): every text and the next document's by
    ascending id, each with its sketch; after the last comes the first.

    Rows with one id follow each other in the order of a hash of their texts; rows
    that repeat id and text are one document with equal results. A null id comes
    first. A narrow table of ids gets dense places from a range-partitioned sort;
    the rows at every so many places are the bounds of buckets, as many as there
    are shuffle partitions, times a constant. The texts are shuffled once, into
    their buckets, and the first document of a bucket a second time, to the end
    of the bucket before. Within a bucket the next document is the next row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.unhex(
            F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text))
        ).alias("key"),
    )
    order = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies"))
    runs = with_position(sorted_runs(order, ["id", "key"], staging, "order"))
    places = staging.save(runs, "places")
    size = places.count()
    once = rows.withColumn("copies", F.lit(1).cast("bigint"))
    repeated = places.where("copies > 1").select("key")
    if not repeated.isEmpty():
        repeated = broadcast_if_small(repeated)
        again = (
            rows.join(repeated, "key", "left_semi")
            .groupBy("key")
            .agg(F.first("id").alias("id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
        )
        once = once.join(repeated, "key", "left_anti").unionByName(again)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, -(-size // (BUCKETS_PER_PARTITION * partitions)))
    first = places.where(F.col(POSITION) % step == 0).select(POSITION, "id", "key").collect()
    kind = rows.schema["id"].dataType
    bounds = F.array(
        *[
            F.struct(F.lit(r["id"]).cast(kind).alias("id"), F.lit(bytes(r["key"])).alias("key"))
            for r in sorted(first, key=lambda r: r[POSITION])
        ]
    )
    place = F.struct("id", "key")
    found = once.withColumn("bucket", _bucket(bounds, len(first), place) if first else F.lit(0))
    own = F.struct(F.col("bucket"), F.lit(0).alias("after"))
    before = F.struct(
        ((F.col("bucket") + len(first) - 1) % max(1, len(first))).alias("bucket"), F.lit(1).alias("after")
    )
    opens = F.get(bounds, F.col("bucket")) == place if first else F.lit(False)
    spread = found.select(
        "id", "key", "text", "copies", F.inline(F.when(opens, F.array(own, before)).otherwise(F.array(own)))
    )
    sketched = spread.repartition("bucket").select("*", sketch(F.col("text")).alias("own"))
    following = Window.partitionBy("bucket").orderBy("after", "id", "key")
    paired = sketched.select(
        "id", "text", "own", "copies", "after",
        F.lead("text").over(following).alias("next_text"),
        F.lead("own").over(following).alias("next_own"),
    ).where("after = 0")
    return paired.select("id", "text", "own", "next_text", "next_own", F.explode(
        F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    )).drop("col")


def _share(common: Column, of: Column) -> Column:
    return F.when(F.size(of) == 0, 0.0).otherwise(common / F.size(of))


def _alike(a: Column, b: Column, common: Column, texts: Column) -> Column:
    """Likeness of two sketches; two empty ones say nothing, so the texts decide."""
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, texts.cast("double")).otherwise(common / either)


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", staging: Staging | None = None
) -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next, in_edited, of_edited, in_next, of_next) of every whole text. The
    edited text has its last quarter of code points (rounded down) replaced by as
    many first ones of the next document. ``near_`` is the likeness of the two
    sketches. Where both are empty, as those of very short texts can be, it is 1
    for equal texts and 0 for others. ``in_`` is the share of the document's
    sketch that the other one holds, ``of_`` the share of the other's that it
    holds; 0 for an empty sketch. Null texts count as empty."""
    staging = staging or Staging(docs.sparkSession)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = with_next(docs, id_col, text_col, staging).select(
        "id", "text", "own", "next_own",
        n.cast("bigint").alias("n_chars"),
        (F.col("text") == F.col("next_text")).alias("repeats"),
        F.concat(
            F.substring(F.col("text"), F.lit(1), n - quarter),
            F.substring(F.col("next_text"), F.lit(1), quarter),
        ).alias("edited"),
    )
    done = edited.select("*", sketch(F.col("edited")).alias("changed")).select(
        "*",
        F.size(F.array_intersect("own", "changed")).alias("kept"),
        F.size(F.array_intersect("own", "next_own")).alias("shared"),
    )
    own, changed, after = F.col("own"), F.col("changed"), F.col("next_own")
    kept, shared = F.col("kept"), F.col("shared")
    return done.select(
        "id",
        "n_chars",
        "edited",
        own.alias("fingerprint"),
        changed.alias("edited_fingerprint"),
        _alike(own, changed, kept, F.col("text") == F.col("edited")).alias("near_edited"),
        _alike(own, after, shared, F.col("repeats")).alias("near_next"),
        _share(kept, own).alias("in_edited"),
        _share(kept, changed).alias("of_edited"),
        _share(shared, own).alias("in_next"),
        _share(shared, after).alias("of_next"),
    )
