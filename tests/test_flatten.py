import pytest

from starmart.operators.flatten import flatten_records


def document(spark, fields: str, content):
    schema = f"data struct<content: array<struct<{fields}>>, other: int>, more: string"
    return spark.createDataFrame([((content, 1), "x")], schema)


def test_flatten_lowers_names_and_keeps_order(spark):
    df = document(spark, "SUSPECT: bigint, tanggal: string, Kode_Prov: string", [(1, "d", "32"), (None, "e", None)])
    flat = flatten_records(df)
    assert flat.columns == ["suspect", "tanggal", "kode_prov"]
    assert {tuple(r) for r in flat.collect()} == {(1, "d", "32"), (None, "e", None)}


@pytest.mark.parametrize("content", [[], None])
def test_documents_without_records(spark, content):
    assert flatten_records(document(spark, "a: int", content)).count() == 0


def test_null_record_gives_null_fields(spark):
    assert [tuple(r) for r in flatten_records(document(spark, "a: int, b: int", [None])).collect()] == [
        (None, None)
    ]


def test_fields_that_differ_by_case(spark, conf):
    conf("spark.sql.caseSensitive", "true")
    with pytest.raises(ValueError, match="case only: \\['a'\\]"):
        flatten_records(document(spark, "A: int, a: int", [(1, 2)]))


def test_other_path(spark):
    df = spark.createDataFrame([([(1,), (2,)],)], "items array<struct<X: int>>")
    assert {r.x for r in flatten_records(df, "items").collect()} == {1, 2}
