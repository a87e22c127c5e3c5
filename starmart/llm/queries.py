"""The registered queries: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    decontaminate,
    fingerprints,
    html_text,
    language,
    minhash,
    passages,
    pii,
    quality,
    resampling,
    secrets,
    tokens,
    warc,
    whitening,
)
from starmart.staging import Staging

VOCABULARY = "byte_bpe_50k.tiktoken"
# Rows that a Python worker holds at once; documents may be long.
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document: its class, the distinct texts in it, and its verified links."""
    members, _ = minhash.near_duplicates(table(spark, folder, "documents"))
    return members.select(
        F.col("id").alias("doc_id"),
        "class_id",
        "class_texts",
        "n_verified_links",
        F.lower(F.hex("text_key")).alias("text_key"),
    )


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = language.held_out(F.col("doc_id"))
    model = language.train(docs.where(~held_out))
    texts = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.identify(texts, model).drop("text")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """A row per passage of a document that another one has as well. Both have it, so a
    linked pair has a row for either; those with doc_id > other_doc_id tell what to cut."""
    found = passages.repeated_passages(table(spark, folder, "documents"))
    sides = ("id", "start", "stop"), ("other_id", "other_start", "other_stop")
    columns = ["doc_id", "other_doc_id", "start", "stop", "other_start", "other_stop", "equal"]
    rows = [
        F.struct(*(F.col(c).alias(n) for c, n in zip([a[0], b[0], *a[1:], *b[1:], "equal"], columns, strict=True)))
        for a, b in (sides, sides[::-1])
    ]
    return found.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    listed = lambda s: F.array_join(
        F.transform(
            s,
            lambda x: F.concat_ws(
                ":", x["kind"], x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[_count(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = tokens.load_ranks(public_tokenizers.path(VOCABULARY))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = tokens.encode_documents(
        docs, ranks, public_tokenizers.PATTERN, keep_ids=False, keep_text=False
    )
    return found.select(
        "doc_id", "tokens.n_tokens", "tokens.ids_sha256", "tokens.decoded_sha256"
    )


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    spans, kinds = F.col("spans"), [r.kind for r in secrets.BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return found.select(
        F.col("id").alias("doc_id"),
        *[_count(spans, kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def warc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Staging(spark).folder("warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.read_warc(spark, path).select(
        warc.page_id_of(F.col("record_id")).cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id_of(F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


def main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract_text(table(spark, folder, "pages"))
    return found.select(
        F.col("id").alias("page_id"),
        "url",
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
    )


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and benchmark item that it holds."""
    hits = decontaminate.benchmark_hits(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return hits.withColumnRenamed("id", "doc_id")


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "in_edited",
        "of_edited",
        "in_next",
        "of_next",
    )


def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality_filter(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


QUERIES = {
    "op1_minhash_near_dedup": near_duplicates,
    "op2_language_id": language_id,
    "op3_substring_dedup": substring_dedup,
    "op4_pii": personal_data,
    "op5_byte_bpe": byte_bpe,
    "op6_secret_scan": secret_scan,
    "op7_warc": warc_roundtrip,
    "op8_html_extraction": main_text,
    "op9_decontamination": decontamination,
    "op10_fingerprints": document_fingerprints,
    "op11_importance_resampling": importance_resampling,
    "op12_embedding_whitening": embedding_whitening,
    "op13_quality_rules": quality_rules,
}

_LETTERS = "".join(map(chr, range(ord("A"), ord("Z") + 1)))


def _bucket_counts_sql(table: str, per_row: bool) -> str:
    """Features of a table's texts; crc32 is computed byte by byte."""
    return f"""{table}_words AS (
      SELECT row_number() OVER () AS r, {"doc_id," if per_row else ""}
             regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM {table}),
    {table}_features AS (
      SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f
      FROM {table}_words)"""


def _resampling_sql() -> str:
    return f"""
    WITH {_bucket_counts_sql("documents", True)}, {_bucket_counts_sql("benchmark", False)},
    byte_table AS (
      SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1
                    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
      FROM range(256) AS t(i)),
    hexed AS (
      SELECT f, hex(encode(f)) AS h
      FROM (SELECT f FROM documents_features UNION SELECT f FROM benchmark_features)),
    hashed AS (
      SELECT f, xor(list_reduce(
               [4294967295] || list_transform(range(0, len(h) // 2),
                 lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
               lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket
      FROM hexed, byte_table),
    source AS (SELECT bucket, count(*) AS n FROM documents_features JOIN hashed USING (f) GROUP BY 1),
    target AS (SELECT bucket, count(*) AS n FROM benchmark_features JOIN hashed USING (f) GROUP BY 1),
    gains AS (
      SELECT bucket, CAST(floor(1000 * ln(
               (coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM documents_features) + 10000)
               / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM benchmark_features) + 10000)))) AS BIGINT) AS gain
      FROM source s LEFT JOIN target t USING (bucket)),
    weights AS (
      SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
      FROM documents_features JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY 1),
    scored AS (
      SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
             coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
             CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
               AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
      FROM documents_words LEFT JOIN weights USING (r)),
    ranked AS (
      SELECT doc_id, n_words, n_features, weight, weight + noise AS score,
             row_number() OVER (PARTITION BY n_words >= {resampling.LEAST_WORDS}
                                ORDER BY weight + noise DESC, doc_id NULLS LAST) AS place,
             count(*) OVER (PARTITION BY n_words >= {resampling.LEAST_WORDS}) AS n
      FROM scored)
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
           CAST(score AS BIGINT) AS score,
           CASE WHEN n_words >= {resampling.LEAST_WORDS} AND place <= {resampling.DRAWN_PERCENT} * n // 100
                THEN place END AS rank
    FROM ranked"""


def _quality_sql() -> str:
    share = f"CAST({quality.FALSE_REJECTION / len(quality.RULES)!r} AS DOUBLE)"
    levels = ", ".join(
        f"least(({r.part} * {r.scale}) // greatest({r.whole}, 1), {quality.LEVELS}) AS {r.name}"
        for r in quality.RULES
    )
    names = [r.name for r in quality.RULES]
    rejects = lambda name: f"coalesce({name} >= from_{name}, FALSE)"
    return f"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    lines AS (
      SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
    runs AS (
      SELECT r, i, count(*) OVER (PARTITION BY r, run) AS times
      FROM (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts))),
    repeats AS (
      SELECT r, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT r, i + unnest([0, 1, 2]) AS place FROM runs WHERE times > 1) GROUP BY r),
    measured AS (
      SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM texts LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
    signals AS (
      SELECT *, {levels},
             n_words < {quality.LEAST_WORDS}
             OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed
      FROM measured),
    docs AS (
      SELECT doc_id, min(lang) AS lang, {", ".join(f"max({n}) AS {n}" for n in names)}
      FROM signals WHERE doc_id IS NOT NULL AND NOT base_failed GROUP BY doc_id),
    marks AS (
      SELECT doc_id, min(quality) <> 0 AS good FROM labels
      WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
    levels AS (
      SELECT lang, rule, level, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
      FROM (UNPIVOT (SELECT docs.*, good FROM docs JOIN marks USING (doc_id))
            ON {", ".join(names)} INTO NAME rule VALUE level) GROUP BY 1, 2, 3),
    strata AS (SELECT lang, sum(good) AS n FROM levels WHERE rule = '{names[0]}' GROUP BY 1),
    chances AS (
      SELECT lang, n, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share})
                      + (n - i) * ln(1 - {share}))) OVER (PARTITION BY lang ORDER BY i) AS chance
      FROM (SELECT lang, n, unnest(range(0, CAST(ceil(n * {share}) AS BIGINT) + 1)) AS i FROM strata)),
    allowed AS (
      SELECT lang, count(*) FILTER (chance <= CAST({quality.RISK!r} AS DOUBLE) / ({len(names)} * (SELECT count(*) FROM strata))) - 1
             AS most FROM chances GROUP BY lang),
    above AS (
      SELECT lang, rule, level, sum(good) OVER down AS good, sum(bad) OVER down AS bad
      FROM levels WINDOW down AS (PARTITION BY lang, rule ORDER BY level DESC)),
    cutoffs AS (
      SELECT above.lang, rule, arg_max(level, (bad - good) * 10000 + level) AS cutoff
      FROM above JOIN allowed ON above.lang IS NOT DISTINCT FROM allowed.lang
      WHERE level > 0 AND bad > good AND good <= most GROUP BY 1, 2),
    wide AS (
      SELECT lang, {", ".join(f"max(cutoff) FILTER (rule = '{n}') AS from_{n}" for n in names)}
      FROM cutoffs GROUP BY lang)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR {" OR ".join(map(rejects, names))}) AS kept,
           concat_ws(',', {", ".join(f"CASE WHEN {rejects(n)} THEN '{n}' END" for n in names)}) AS failed_rules
    FROM signals LEFT JOIN wide ON signals.lang IS NOT DISTINCT FROM wide.lang"""


ORACLE_SQL = {
    "op7_warc": f"""
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               refers_to
        FROM (SELECT page_id, payload_bytes, payload_digest,
                     CASE WHEN payload_bytes >= {warc.LEAST_SHARED_BYTES} AND page_id <> first
                          THEN first END AS refers_to
              FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                           sha256(coalesce(html, '')) AS payload_digest,
                           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
                    FROM pages))""",
    "op11_importance_resampling": _resampling_sql(),
    "op13_quality_rules": _quality_sql(),
}
