"""A training-corpus pipeline over ``documents``: five stages, each an operator
of ``starmart.llm`` whose decisions take effect on what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontaminate, language, minhash, pii, tokens
from starmart.llm.queries import ROWS_AT_ONCE, VOCABULARY, table
from starmart.staging import Staging

# A text whose n-grams belong to its best language to a smaller share is in none.
LEAST_LANGUAGE_SCORE = 0.5


def _bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """The row as one column ``row`` beside the columns that an operator reads, so
    that no name of a document clashes with a name of its own."""
    return docs.select(F.struct("*").alias("row"), *names)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language; fills missing labels in."""
    _bounded_batches(spark)
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(_packed(docs, "text"), model)
    kept = found.where(
        (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    )
    lang = F.coalesce("row.lang", "lang_pred")
    return kept.select(F.col("row").withField("lang", lang).alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class."""
    _bounded_batches(spark)
    with Staging(spark) as staging:
        members, _ = minhash.near_duplicates(docs, staging=staging)
        members = Staging(spark).save(members, "members")
    return minhash.one_of_each(docs, members, "doc_id", "text").select(*docs.columns)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    _bounded_batches(spark)
    key = F.xxhash64("doc_id", "text")
    with Staging(spark) as staging:
        hits = decontaminate.benchmark_hits(
            docs.select(key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), id_col="key",
            staging=staging,
        )
        # Written first: its size then decides how the join runs.
        held = Staging(spark).save(hits.select(F.col("id").alias("held")).distinct(), "held")
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(held, F.col("key") == F.col("held"), "left_anti").select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the text."""
    _bounded_batches(spark)
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


TOKEN_COLUMNS = {"token_ids": "ids", "n_tokens": "n_tokens", "ids_sha256": "ids_sha256",
                 "decoded_sha256": "decoded_sha256"}


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, ready for training. Columns of the
    documents that are named like the new ones are replaced."""
    _bounded_batches(spark)
    ranks = tokens.load_ranks(public_tokenizers.path(VOCABULARY))
    found = tokens.encode_documents(
        _packed(docs, "text"), ranks, public_tokenizers.PATTERN, keep_text=False
    )
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in TOKEN_COLUMNS],
        *[F.col("tokens").getField(f).alias(c) for c, f in TOKEN_COLUMNS.items()],
    )


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_texts),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]

# The stages decide by trained filters, sampling and merges: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and
    read again as the next one's input."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.save(stage(spark, docs, sf_dir), name)
    return docs
