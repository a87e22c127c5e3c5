"""Secret scans through a trigram inverted index (operator 6).

Each rule's regular expression yields a Boolean trigram query. The index holds a
posting (trigram, document) for every trigram that some query asks for.
Intersecting the postings gives each rule's candidates, and only they are
verified by the expression itself. A rule without mandatory trigrams scans all
texts. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` reads the same in Java and in Python. ``least`` code points
    of group ``group`` make a match count; shorter ones are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The rules, in the order in which kinds are listed. Runs that
# must have a least length say so in the pattern where that finds the same
# spans: a run is taken whole, and no part of a short run is long enough.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE_RULES + ADDED_RULES
BLOCK = 256

SPAN = "array<struct<start: bigint, place: int, kind: string, stop: bigint>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), 0)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _running(numbers: Column) -> Column:
    """For each number the sum of those before, by sums of blocks."""
    n = F.size(numbers)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _total(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))))
    before = _let(
        sums, lambda s: F.transform(s, lambda _, b: _total(F.slice(s, F.lit(1), b)))
    )
    return _let(
        before,
        lambda base: F.transform(
            numbers,
            lambda _, i: F.get(base, F.floor(i / BLOCK).cast("int"))
            + _total(F.slice(numbers, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
        ),
    )


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """All spans of the rule, in code points of ``text``. What lies between the
    matches comes from a split by the same expression, so running lengths give
    the places."""
    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("core"),
        F.split(text, rule.pattern, -1).alias("gaps"),
    )

    def placed(p: Column) -> Column:
        lengths = F.transform(
            p["found"],
            lambda m, i: (F.length(m) + F.length(F.get(p["gaps"], i))).cast("bigint"),
        )

        def spans(before: Column) -> Column:
            every = F.transform(
                p["found"],
                lambda m, i: F.struct(
                    (F.get(before, i) + F.length(F.get(p["gaps"], i))).alias("start"),
                    F.lit(place).alias("place"),
                    F.lit(rule.kind).alias("kind"),
                    (F.get(before, i) + F.length(F.get(p["gaps"], i)) + F.length(m)).alias("stop"),
                    F.length(F.get(p["core"], i)).alias("long"),
                ),
            )
            kept = F.filter(every, lambda s: s["long"] >= rule.least)
            return F.transform(
                kept, lambda s: F.struct(s["start"], s["place"], s["kind"], s["stop"])
            ).cast(SPAN)

        return _let(lengths, lambda x: _let(_running(x), spans))

    none = F.array().cast(SPAN)
    return F.when(F.rlike(text, pattern), _let(parts, placed)).otherwise(none)


def _candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, rules): the indexed rules whose trigram query a document meets."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    wanted = sorted({t for q in queries.values() for t in q.trigrams})
    low = F.lower("text")
    held = F.filter(
        F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in wanted]),
        lambda t: t.isNotNull(),
    )
    postings = docs.select("key", low.alias("low")).select("key", F.explode(held).alias("trigram"))
    asked = [
        (kind, c, a, trigram, len(alternative), len(query.clauses))
        for kind, query in queries.items()
        for c, clause in enumerate(query.clauses)
        for a, alternative in enumerate(clause)
        for trigram in alternative
    ]
    # A few rows per rule, whatever the corpus.
    table = docs.sparkSession.createDataFrame(
        asked, "kind STRING, clause INT, alternative INT, trigram STRING, size INT, clauses INT"
    )
    return (
        postings.join(F.broadcast(table), "trigram")
        .groupBy("key", "kind", "clause", "alternative", "size", "clauses")
        .agg(F.count_distinct("trigram").alias("n"))
        .where("n = size")
        .groupBy("key", "kind", "clauses")
        .agg(F.count_distinct("clause").alias("n"))
        .where("n = clauses")
        .groupBy("key")
        .agg(F.collect_set("kind").alias("rules"))
    )


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """(id, spans): spans are (start, place, kind, stop) by start, then kind in
    the order of ``rules``; stop exclusive, in code points. One row per row of
    ``docs``, repeated and null ids included (rows that share an id share the
    candidate rules, which only saves work). Null texts count as empty and have
    no spans."""
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
    )
    indexed = [r for r in rules if trigram_query(r.pattern).clauses]
    known = F.array().cast("array<string>")
    if indexed:
        found = _candidates(texts, indexed).withColumnRenamed("key", "found_key")
        texts = texts.join(found, F.col("key") == F.col("found_key"), "left")
        known = F.coalesce(F.col("rules"), known)
    text = F.col("text")
    spans = []
    for place, rule in enumerate(rules):
        found = _spans(text, rule, place)
        if rule in indexed:
            found = F.when(F.array_contains(known, rule.kind), found)
            found = found.otherwise(F.array().cast(SPAN))
        spans.append(found)
    return texts.select("id", F.array_sort(F.concat(*spans)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )
