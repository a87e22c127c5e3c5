"""One large JSON document, read by many tasks.

The file is cut after every closing brace, at the places where its byte ranges
happen to lie, so a range is read without the others. What a piece means depends
on all before it: whether it begins inside a text, and how deep. Both are sums:
quotes modulo two, and brackets outside texts, counted for either way to begin.
They are added up within each range, and one row per range carries them on to the
next. Then every piece knows its depth, the arrays that hold records are found by
the keys that lead to them, and a piece that begins and ends between two records
is a record. Records in several pieces (braces in texts, nested values) are put
together; no other text is shuffled for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.flatten import RECORDS
from starmart.operators.lookup import broadcast_if_small
from starmart.staging import Staging

CUT = "}"
# Stand in for an escaped backslash and an escaped quote: no JSON text holds them.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_BLANKS = " \t\n\x0b\f\r"
_STRING = r'"[^"]*(?:"|$)'
_HEAD = r'^[^"]*(?:"|$)'
_TOKEN = rf'{_STRING}|[\[\]{{}}:,]|[^"\[\]{{}}:,]+'


class DocumentError(ValueError):
    """A file is no JSON object with records where they are looked for."""


def _guarded(text: Column) -> Column:
    """The text with escapes replaced, so that every quote begins or ends a text."""
    return F.replace(
        F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE)
    )


def _unguarded(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _number_of(char: str, text: Column) -> Column:
    """How often a character of one byte occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def _opened(text: Column) -> Column:
    return _number_of("{", text) + _number_of("[", text)


def _after_comma(text: Column) -> Column:
    """The text without blanks and one comma before it."""
    text = F.ltrim(text, F.lit(_BLANKS))
    return F.when(text.startswith(","), F.ltrim(F.substr(text, F.lit(2)), F.lit(_BLANKS))).otherwise(text)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Guarded text between closing braces, with its place and what it adds to
    quotes and depth, if its range begins outside (0) or inside (1) a text."""
    guarded = _guarded(F.col("value"))
    read = (
        spark.read.option("lineSep", CUT)
        .text(path)
        .select(
            guarded.alias("text"),
            (F.octet_length("value") + 1).alias("bytes"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    text = F.col("text")
    brackets = F.col("all_opened") + F.col("all_closed")
    counted = read.select(
        "*",
        _number_of('"', text).cast("bigint").alias("quotes"),
        _opened(text).alias("all_opened"),
        _number_of("]", text).alias("all_closed"),
    )
    # What lies outside texts, if the piece begins outside one. If it begins inside
    # one, that is what lies inside, and the rest outside. Most pieces have a single
    # bracket, whose place among the quotes tells.
    first = F.substring_index(F.substring_index(F.substring_index(text, "{", 1), "[", 1), "]", 1)
    counted = counted.select(
        "*",
        F.when(brackets <= 1, 1 - _number_of('"', first) % 2).alias("lies_outside"),
        F.when(brackets > 1, F.regexp_replace(text, _STRING, "")).alias("outside"),
    )
    of_outside = lambda n, number: F.when(brackets > 1, number(F.col("outside"))).otherwise(
        F.col(n) * F.col("lies_outside")
    )
    counted = counted.withColumn("opened", of_outside("all_opened", _opened)).withColumn(
        "closed0", of_outside("all_closed", lambda x: _number_of("]", x))
    )
    # The brace after a piece counts unless a text holds it.
    odd = F.col("quotes") % 2
    counted = counted.withColumn("closed1", F.col("all_closed") - F.col("closed0")).select(
        *read.columns,
        "quotes",
        "closed0",
        "closed1",
        (F.col("opened") - F.col("closed0") - 1 + odd).cast("bigint").alias("out"),
        (F.col("all_opened") - F.col("opened") - F.col("closed1") - odd).cast("bigint").alias("in"),
    )
    earlier = (
        Window.partitionBy("file", "range").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    even = F.col("flips") == 0
    return (
        counted.withColumn("flips", before("quotes") % 2)
        .withColumn("step0", F.when(even, F.col("out")).otherwise(F.col("in")))
        .withColumn("step1", F.when(even, F.col("in")).otherwise(F.col("out")))
        .withColumn("sum0", before("step0"))
        .withColumn("sum1", before("step1"))
        .drop("out", "in")
    )


def _ranges(pieces: DataFrame) -> DataFrame:
    """(file, range, inside, level): the state in which each range begins, and the
    same at the end of each. A row per range, added up by file."""
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    return (
        pieces.groupBy("file", "range")
        .agg(
            F.sum("quotes").alias("quotes"),
            F.sum("step0").alias("step0"),
            F.sum("step1").alias("step1"),
            F.sum("bytes").alias("bytes"),
            F.first("size").alias("size"),
        )
        .withColumn("inside", before("quotes") % 2)
        .withColumn("step", F.when(F.col("inside") == 0, F.col("step0")).otherwise(F.col("step1")))
        .withColumn("level", before("step"))
    )


def _located(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pieces with ``inside`` and ``depth`` where they begin and after their brace, and
    the brackets that they close outside texts."""
    state = broadcast_if_small(
        ranges.select("file", "range", F.col("inside").alias("s"), F.col("level"))
    )
    outside = F.col("s") == 0
    return (
        pieces.join(state, ["file", "range"])
        .select(
            "file",
            F.struct("range", "seq").alias("at"),
            "text",
            ((F.col("s") + F.col("flips")) % 2 == 1).alias("inside"),
            (F.col("level") + F.when(outside, F.col("sum0")).otherwise(F.col("sum1"))).alias("depth"),
            F.when(outside, F.col("step0")).otherwise(F.col("step1")).alias("step"),
            "quotes",
            "closed0",
            "closed1",
        )
        .select(
            "file",
            "at",
            "text",
            "inside",
            "depth",
            (F.col("depth") + F.col("step")).alias("after"),
            (F.col("inside") != (F.col("quotes") % 2 == 1)).alias("inside_after"),
            F.when(F.col("inside"), F.col("closed1")).otherwise(F.col("closed0")).alias("closed"),
        )
    )


def _check_whole(ranges: DataFrame, located: DataFrame) -> None:
    """Raises unless every file is one JSON object and nothing else."""
    ends = ranges.groupBy("file").agg(
        F.sum("step").alias("depth"),
        (F.sum("quotes") % 2).alias("inside"),
        F.sum("bytes").alias("bytes"),
        F.first("size").alias("size"),
    )
    # A file that does not end with a brace has one more piece, whose brace is not there.
    missing = (F.col("bytes") - F.col("size")).cast("bigint")
    whole = (F.col("inside") == 0) & missing.isin(0, 1) & (F.col("depth") == -missing)
    broken = ends.where(~whole).select("file").limit(1).collect()
    if broken:
        raise DocumentError(f"{broken[0][0]} is cut off or no single JSON object")
    first = Window.partitionBy("file").orderBy("at")
    shallow = located.where("depth <= 0 AND NOT inside").withColumn("n", F.row_number().over(first))
    fits = F.when(F.col("n") == 1, F.col("text").rlike(r"^\s*\{")).otherwise(F.col("text").rlike(r"^\s*$"))
    odd = shallow.where(~fits).select("file").limit(1).collect()
    if odd:
        raise DocumentError(f"{odd[0][0]} holds more than one JSON object")


def _openings(text: Column, inside: Column, depth: Column, levels: int) -> Column:
    """The last container that a piece opens at each of the first levels, as key
    and bracket, and what follows the last one of them."""
    head = F.when(inside, F.regexp_extract(text, _HEAD, 0)).otherwise(F.lit(""))
    tokens = F.regexp_extract_all(F.substr(text, F.length(head) + 1), F.lit(_TOKEN), F.lit(0))
    nothing = F.lit(None).cast("string")
    start = F.struct(
        depth.cast("bigint").alias("depth"),
        nothing.alias("text"),
        nothing.alias("key"),
        F.array_repeat(nothing, levels).alias("opened"),
        F.lit(0).alias("n"),
        F.lit(0).alias("last"),
    )

    def read(state: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token == "]"
        level = state["depth"]
        here = opens & (level >= 1) & (level <= levels)
        name = F.concat(F.coalesce(state["key"], F.lit("")), token)
        opened = F.transform(
            state["opened"], lambda old, i: F.when(here & (i + 1 == level), name).otherwise(old)
        )
        return F.struct(
            (level + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
            F.when(token.startswith('"'), token).otherwise(state["text"]).alias("text"),
            F.when(token == ":", state["text"])
            .when(opens | closes | (token == ","), nothing)
            .otherwise(state["key"])
            .alias("key"),
            opened.alias("opened"),
            (state["n"] + 1).alias("n"),
            F.when(here & (level == levels), state["n"] + 1).otherwise(state["last"]).alias("last"),
        )

    end = F.aggregate(tokens, start, read)
    rest = lambda e: F.array_join(F.slice(tokens, e["last"] + 1, F.size(tokens)), "")
    return F.get(
        F.transform(F.array(end), lambda e: F.struct(e["opened"].alias("opened"), rest(e).alias("rest"))), 0
    )


def _arrays(located: DataFrame, path: list[str], staging: Staging) -> DataFrame:
    """(file, since, until, rest): from which piece up to before which other one
    records lie in an array at the path. Pieces that open a container so far out
    are the frame of a document, not its records."""
    levels = len(path)
    outer = located.where(F.col("depth") - F.col("closed") <= levels).select(
        "file", "at", _openings(F.col("text"), F.col("inside"), F.col("depth"), levels).alias("found")
    )
    opened = [F.get(F.col("found.opened"), i) for i in range(levels)]
    frame = staging.save(
        outer.where(F.exists(F.col("found.opened"), lambda o: o.isNotNull())).select(
            "file", "at", "found.rest", *[o.alias(f"open{i}") for i, o in enumerate(opened)]
        ),
        "frame",
    )
    order = Window.partitionBy("file").orderBy("at")
    held = frame.select(
        "*",
        *[F.last(f"open{i}", ignorenulls=True).over(order).alias(f"within{i}") for i in range(levels - 1)],
    )
    wanted = F.col(f"open{levels - 1}") == f'"{path[-1]}"['
    for i, key in enumerate(path[:-1]):
        wanted &= F.coalesce(F.col(f"within{i}") == f'"{key}"{{', F.lit(False))
    return (
        held.where(F.col(f"open{levels - 1}").isNotNull())
        .select(
            "file",
            F.col("at").alias("since"),
            F.lead("at").over(order).alias("until"),
            F.col("rest"),
            wanted.alias("wanted"),
        )
        .where("wanted")
        .drop("wanted")
    )


def split_records(
    spark: SparkSession, path: str | list[str], records: str = RECORDS, staging: Staging | None = None
) -> DataFrame:
    """The records of documents, one JSON object per file, as JSON texts in the
    column ``record``. Files are split whatever their size, unless compressed.

    Raises if a file is cut off or holds anything but one object, and if there is
    anything but objects among the records. Keys of the path are compared as written.
    """
    staging = staging or Staging(spark)
    keys = records.split(".")
    if any(c in key for key in keys for c in '"\\{}[]'):
        raise ValueError(f"cannot look for {records}")
    with Staging(spark) as held:
        pieces = held.save(_pieces(spark, path), "pieces")
        ranges = held.save(_ranges(pieces), "ranges")
        located = _located(pieces, ranges)
        _check_whole(ranges, located)
        arrays = held.save(_arrays(located, keys, held), "arrays")
        # Looked at once, as callers may read the records more than once.
        whole = staging.save(_elements(located, arrays, len(keys) + 1), "elements").where("body IS NOT NULL")
    alone = whole.where("begins AND ends").select(F.col("body").alias("record"))
    parts = whole.where("NOT (begins AND ends)").select("file", "at", "body", "begins")
    found = alone.unionByName(staging.save(_joined(parts), "joined"))
    return found.select(_unguarded(F.concat("record", F.lit(CUT))).alias("record"))


def _elements(located: DataFrame, arrays: DataFrame, level: int) -> DataFrame:
    """(file, at, body, begins, ends): the pieces of records, and which begin or end
    one; without a body, what lies behind an array. No filter by the body follows here:
    Spark would do its work again for that, in a method too long to be compiled."""
    here = (F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    opening = F.col("at") == F.col("since")
    among = (
        located.join(broadcast_if_small(arrays), "file")
        .where(here)
        .select(
            "file",
            "at",
            F.when(opening, F.col("rest")).otherwise(F.col("text")).alias("text"),
            (opening | ((F.col("depth") == level) & ~F.col("inside"))).alias("between"),
            (F.col("depth") > level).alias("deep"),
            ((F.col("after") == level) & ~F.col("inside_after")).alias("ends"),
        )
        .withColumn("text", F.when(F.col("between"), _after_comma(F.col("text"))).otherwise(F.col("text")))
        .withColumn("begins", F.col("between") & F.col("text").startswith("{"))
    )
    # Between records there is nothing else, and after the last one the end of the array.
    other = F.col("between") & ~F.col("begins") & ~F.col("text").startswith("]")
    message = F.concat(F.lit("an element is no object: "), F.substring("text", 1, 40))
    held = F.col("begins") | (~F.col("between") & F.col("deep"))
    body = F.when(held, F.col("text")).when(other, F.raise_error(message))
    return among.select("file", "at", body.alias("body"), "begins", "ends")


def _joined(parts: DataFrame) -> DataFrame:
    """Records of several pieces: each belongs to the last beginning up to it."""
    place = ["file", F.col("at.range").alias("range")]
    begun = F.col("begins").cast("bigint")
    so_far = Window.partitionBy("file", "range").orderBy("at")
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        parts.select(*place, begun.alias("n"))
        .groupBy("file", "range")
        .agg(F.sum("n").alias("n"))
        .select("file", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    numbered = parts.select(*place, "at", "body", begun.alias("n")).withColumn(
        "n", F.sum("n").over(so_far)
    )
    pieces = (
        numbered.join(broadcast_if_small(before), ["file", "range"])
        .groupBy("file", (F.col("before") + F.col("n")).alias("number"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "body"))).alias("pieces"))
    )
    bodies = F.transform("pieces", lambda p: p["body"])
    return pieces.select(F.array_join(bodies, CUT).alias("record"))
