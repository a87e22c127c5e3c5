import json

import pytest
from fixtures import SMALL_RECORDS, SMALL_SPEC, raw_of, small_raw
from shapes import rows

from starmart import CASE_SPEC, ingest
from starmart.sinks.files import land
from starmart.sources.files import (
    CSV_LOSSLESS,
    document_schema,
    header_groups,
    read_csv,
    read_csv_text,
    read_documents,
    read_parquet,
)

ODD_ROWS = [
    ("2020-08-05", "", " 3 ", 5, None),
    (" 2020", None, 'a "quoted", \\ text\\', None, -1),
    ("", "032", "N", None, None),
]


@pytest.fixture
def document(tmp_path):
    """One multi-line file, with a field that the spec does not know."""
    path = tmp_path / "doc.json"
    content = [{**r, "SUSPECT": 1} for r in SMALL_RECORDS]
    path.write_text(json.dumps({"data": {"content": content}, "status": 200}, indent=2))
    return str(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ingest_multi_line(spark, tmp_path, document, fmt):
    target = str(tmp_path / "raw")
    ingest(spark, document, target, document_schema(CASE_SPEC), multi_line=True, partitions=3, fmt=fmt)
    read = read_parquet if fmt == "parquet" else read_csv
    assert rows(read(spark, target, CASE_SPEC)) == rows(small_raw(spark))


def test_ingest_with_inferred_schema_lands_all_fields(spark, tmp_path, document):
    target = str(tmp_path / "raw")
    ingest(spark, document, target, None, multi_line=True)
    landed = spark.read.parquet(target)
    assert "suspect" in landed.columns and len(landed.columns) == 17
    assert rows(read_parquet(spark, target, CASE_SPEC)) == rows(small_raw(spark))


def test_documents_as_lines(spark, tmp_path):
    path = tmp_path / "docs.json"
    lines = [{"data": {"content": [r]}} for r in SMALL_RECORDS] + [{"data": {}}, {"data": {"content": []}}]
    path.write_text("\n".join(json.dumps(x) for x in lines))
    ingest(spark, str(path), str(tmp_path / "raw"), document_schema(CASE_SPEC))
    assert rows(read_parquet(spark, str(tmp_path / "raw"), CASE_SPEC)) == rows(small_raw(spark))


def test_numeric_codes_stay_text(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"data": {"content": [{"kode_prov": 32, "kode_kab": "032"}]}}))
    df = read_documents(spark, str(path), document_schema(CASE_SPEC))
    record = df.first().data.content[0]
    assert (record.kode_prov, record.kode_kab) == ("32", "032")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_landing_keeps_nulls_blanks_and_quotes(spark, tmp_path, fmt):
    raw = raw_of(spark, ODD_ROWS)
    path = str(tmp_path / "raw")
    if fmt == "csv":
        land(raw, path, "csv", **CSV_LOSSLESS)
        back = read_csv(spark, path, SMALL_SPEC, **CSV_LOSSLESS)
    else:
        land(raw, path)
        back = read_parquet(spark, path, SMALL_SPEC)
    assert back.schema == raw.schema
    assert rows(back) == rows(raw)


def test_landing_overwrites(spark, tmp_path):
    path = str(tmp_path / "raw")
    land(raw_of(spark, ODD_ROWS), path)
    land(raw_of(spark, ODD_ROWS[:1]), path)
    assert read_parquet(spark, path, SMALL_SPEC).count() == 1


def test_csv_by_name_with_other_separator(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a_x;kode_kab;x;b_y;nama_kab;tanggal;kode_prov;nama_prov\n1;032;z;;N;2020-08-05;07;W\n")
    got = read_csv(spark, str(path), SMALL_SPEC, sep=";")
    assert [tuple(r) for r in got.collect()] == [("2020-08-05", "07", "W", "032", "N", None, 1)]
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv(spark, str(path), SMALL_SPEC)


def test_csv_as_text(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b\n1,032\n,x\n")
    got = read_csv_text(spark, str(path))
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string"]
    assert [tuple(r) for r in got.collect()] == [("1", "032"), (None, "x")]


def lines(path, *documents):
    path.write_text("\n".join(json.dumps({"data": {"content": d}}) for d in documents) + "\n")
    return str(path)


def spelled(record, spell):
    return {spell(k): v for k, v in record.items()}


@pytest.mark.parametrize("declared", [True, False])
def test_every_record_may_spell_its_fields_in_its_own_way(spark, tmp_path, declared):
    a, b, c, d = SMALL_RECORDS
    path = lines(tmp_path / "docs.json", [spelled(a, str.upper), b], [spelled(c, str.title)], [], [d])
    target = str(tmp_path / "raw")
    ingest(spark, path, target, document_schema(CASE_SPEC) if declared else None)
    assert rows(read_parquet(spark, target, CASE_SPEC)) == rows(small_raw(spark))


def test_two_files_in_two_spellings(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    lines(folder / "1.json", [{"TANGGAL": "2020-08-05", "SUSPECT_DIISOLASI": 1}])
    lines(folder / "2.json", [{"tanggal": "2020-08-06", "suspect_diisolasi": 2}])
    for schema in (None, document_schema(CASE_SPEC)):
        ingest(spark, str(folder), str(tmp_path / "raw"), schema)
        landed = spark.read.parquet(str(tmp_path / "raw")).select("tanggal", "suspect_diisolasi")
        assert rows(landed) == [("2020-08-05", 1), ("2020-08-06", 2)]


def test_fields_of_a_record_that_differ_by_case_raise(spark, tmp_path):
    path = lines(tmp_path / "docs.json", [{"tanggal": "a"}], [{"tanggal": "a", "TANGGAL": "b"}])
    with pytest.raises(Exception, match="differ by case only: TANGGAL, tanggal"):
        ingest(spark, path, str(tmp_path / "raw"))


def test_records_without_a_declared_field_raise(spark, tmp_path):
    path = lines(tmp_path / "docs.json", [{"tanggal": "a"}, {}, None], [{"datum": "b"}])
    with pytest.raises(Exception, match="none of the declared fields, but datum"):
        ingest(spark, path, str(tmp_path / "raw"), document_schema(CASE_SPEC))
    ingest(spark, path, str(tmp_path / "all"))
    landed = spark.read.parquet(str(tmp_path / "all"))
    assert rows(landed) == [(None, None), (None, None), (None, "b"), ("a", None)]


def test_values_keep_their_digits_and_counts_must_be_integers(spark, tmp_path):
    path = lines(tmp_path / "docs.json", [{"kode_prov": 7, "x": 12.50, "y": {"z": [1, None]}, "w": True}])
    ingest(spark, path, str(tmp_path / "raw"))
    landed = spark.read.parquet(str(tmp_path / "raw")).first().asDict()
    assert landed == {"kode_prov": "7", "x": "12.5", "y": '{"z": [1, null]}', "w": "true"}
    for wrong in (12.5, "x", True, [1]):
        bad = lines(tmp_path / "bad.json", [{"tanggal": "2020-08-05", "suspect_diisolasi": wrong}])
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            ingest(spark, bad, str(tmp_path / "bad"))


def test_malformed_documents_raise(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"data":{"content":[{"tanggal":"a"}]}}\n{"data":{"content":[{"tang\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        ingest(spark, str(path), str(tmp_path / "raw"))


def test_csv_files_with_different_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "1.csv").write_text("tanggal,kode_prov,nama_prov,kode_kab,nama_kab,b_y,a_x\n2020-08-05,1,P,10,K,5,6\n")
    (folder / "2.csv").write_text("a_x,note,b_y,nama_kab,kode_kab,nama_prov,kode_prov,tanggal\n8,n,7,K,10,P,1,2020-08-06\n")
    (folder / "3.csv").write_text("tanggal,kode_prov,nama_prov,kode_kab,nama_kab,b_y,a_x\n2020-08-07,1,P,10,K,,\n")
    (folder / "4.csv").write_text("")
    (folder / "_5.csv").write_text("x\n1\n")
    assert [len(g) for g in header_groups(spark, str(folder))] == [2, 1]
    got = rows(read_csv(spark, str(folder), SMALL_SPEC))
    assert [(r[0], *r[-2:]) for r in got] == [("2020-08-05", 5, 6), ("2020-08-06", 7, 8), ("2020-08-07", None, None)]
    text = read_csv_text(spark, f"{folder}/[12].csv")
    assert text.columns[-1] == "note" and rows(text.select("a_x", "note")) == [("6", None), ("8", "n")]
    (folder / "6.csv").write_text("tanggal,kode_prov\n2020-08-08,1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv(spark, str(folder), SMALL_SPEC)
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none"), SMALL_SPEC)


def test_compressed_csv(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "a STRING, b STRING").write.option("header", True).option(
        "compression", "gzip"
    ).csv(str(tmp_path / "c"))
    assert rows(read_csv_text(spark, str(tmp_path / "c"))) == [("1", "x")]
