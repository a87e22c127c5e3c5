"""The corpus pipeline and its registration."""

from __future__ import annotations

import os

import pytest
from conftest import edited, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, extra STRING"


def _folder(tmp_path, spark, rows, items):
    docs = spark.createDataFrame(
        [(i, t, lang, "s", len(t or ""), "e") for i, t, lang in rows], COLUMNS
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    return str(tmp_path)


def test_each_decision_takes_effect(spark, tmp_path):
    base, item = prose(1, 200), prose(99, 40)
    rows = [(i, prose(i, 200), "en") for i in range(1, 9)]
    rows += [
        (20, base, "en"),
        (21, edited(base, 70), "en"),
        (22, "123 456 !!", None),
        (23, None, "en"),
        (24, prose(50, 60) + " " + item + " " + prose(51, 60), "en"),
        (25, prose(60, 80) + " write to a.b@c.org now", "en"),
        (None, prose(70, 100), None),
    ]
    folder = _folder(tmp_path, spark, rows, [(1, item)])
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, 8, 25, None}
    assert found[25]["text"].endswith("write to [EMAIL] now")
    assert found[25]["n_chars"] == len(found[25]["text"])
    assert found[None]["lang"] == "en" and found[None]["extra"] == "e"
    assert all(r["n_tokens"] == len(r["token_ids"]) > 0 for r in found.values())


def test_empty_tables(spark, tmp_path):
    folder = _folder(tmp_path, spark, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


NAMES = (
    "id", "row", "key", "held", "lang_pred", "score", "tokens", "found", "stays",
    "_key", "_found", "_held", "_tokens", "_lang", "_score", "_stays",
)


def test_stages_keep_the_columns(spark):
    """Columns with the names that operators use come back as they were."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.lit(n).alias(n) for n in NAMES]).coalesce(1).cache()
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        columns = found.columns[: len(docs.columns)]
        assert columns == docs.columns and (found.columns == columns) == (name != "byte_bpe")
        rows = found.collect()
        assert rows and all(r[n] == n for r in rows for n in NAMES)
    docs.unpersist()


def test_token_columns_replace_those_of_their_name(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id BIGINT, text STRING, n_tokens STRING")
    found = corpus_pipeline.encode(spark, docs, FOLDER)
    assert found.columns == ["doc_id", "text", *corpus_pipeline.TOKEN_COLUMNS]
    assert found.first()["n_tokens"] == len(found.first()["token_ids"])


@pytest.mark.parametrize("name", [n for n in entry.CORPUS if n != "pipeline"])
def test_queries_run(spark, name):
    tables = {"op7": ("pages", "page_id"), "op8": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}
    operator = name.split("_")[0]
    table, key = tables.get(operator, ("documents", "doc_id"))
    found = entry.queries()[name](spark, FOLDER)
    assert found.columns[0] == key
    if operator not in ("op3", "op9"):
        rows = found.select(key).distinct() if operator == "op12" else found
        assert rows.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_held_out_languages(spark):
    found = entry.queries()["op2_language_id"](spark, FOLDER).where("held_out")
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    right = found.join(known, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.95
