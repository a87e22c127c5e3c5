"""Large documents read by many tasks, against a JSON parser."""

import json
import random

import pytest
from fixtures import SMALL_RECORDS, small_raw
from shapes import rows

from starmart import CASE_SPEC, ingest
from starmart.operators.flatten import field_names
from starmart.sources.files import read_parquet, read_records
from starmart.sources.split_json import DocumentError, split_records
from starmart.staging import Staging

TEXTS = ["", "}", "{", '"', "\\", '\\"', "}]", 'a"}b', "\\\\", "é𝒳", "\n}", "x" * 30, ',{"tanggal":1}', "content"]


def value(rng, depth=0):
    kind = rng.random()
    if depth < 3 and kind < 0.15:
        return {rng.choice(TEXTS + ["data", "content"]): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    if depth < 3 and kind < 0.3:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, 12, -1.5, *TEXTS])


def document(rng):
    content = [{f"f{k}": value(rng) for k in range(rng.randint(0, 4))} for _ in range(rng.randint(0, 12))]
    data = {f"d{k}": value(rng, 1) for k in range(rng.randint(0, 2))}
    data["content"] = content
    data |= {f"e{k}": value(rng, 1) for k in range(rng.randint(0, 2))}
    whole = {f"g{k}": value(rng) for k in range(rng.randint(0, 2))}
    whole["data"] = data
    whole |= {f"h{k}": value(rng) for k in range(rng.randint(0, 2))}
    return whole, content


@pytest.mark.parametrize("size", ["40", "300", "100000"])
def test_split_documents_equal_a_parser(spark, tmp_path, conf, size):
    """Ranges of 40 bytes cut records, texts and keys anywhere."""
    conf("spark.sql.files.maxPartitionBytes", size)
    conf("spark.sql.files.openCostInBytes", "0")
    rng, expected = random.Random(size), []
    for i in range(25):
        whole, content = document(rng)
        text = json.dumps(whole, indent=rng.choice([None, 1, 4]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{i}.json").write_text(text + rng.choice(["", "\n", "  \n"]))
        expected += content
    found = [json.loads(r[0]) for r in split_records(spark, str(tmp_path)).collect()]
    text = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(text, found)) == sorted(map(text, expected))


def test_one_document_is_read_by_many_tasks(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "2000")
    conf("spark.sql.files.openCostInBytes", "0")
    content = [{**r, "NOTE": '}], {"tanggal": "\\" }', "x": {"y": [{}, {"z": i}]}} for i in range(20) for r in SMALL_RECORDS]
    path = tmp_path / "doc.json"
    whole = {"status": {"content": [{"tanggal": 0}]}, "data": {"content": content}}
    path.write_text(json.dumps(whole, separators=(",", ":")))
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 5
    ingest(spark, str(path), str(tmp_path / "split"), split=True)
    ingest(spark, str(path), str(tmp_path / "whole"), multi_line=True)
    split, whole = (spark.read.parquet(str(tmp_path / n)) for n in ("split", "whole"))
    assert split.columns == whole.columns and "note" in split.columns
    assert rows(split) == rows(whole) and split.count() == 80


def test_declared_fields_of_a_split_document(spark, tmp_path):
    path = tmp_path / "doc.json"
    upper = [{k.upper(): v for k, v in r.items()} for r in SMALL_RECORDS]
    path.write_text(json.dumps({"data": {"content": upper}}, indent=2))
    ingest(spark, str(path), str(tmp_path / "raw"), split=True)
    assert rows(read_parquet(spark, str(tmp_path / "raw"), CASE_SPEC)) == rows(small_raw(spark))


@pytest.mark.parametrize(
    "text",
    [
        '{"data":{"content":[{"a":1}]}', '{"data":{"content":[{"a":1}]}\n', '{"data":{"content":[{"a":1',
        '{"data":{"content":[{"a":"1}]}}', '{"data":{"content":[{"a":1}]}}}', '{"data":{"content":[{"a":1}]}} x',
        '{"data":{"content":[{"a":1}]}}{"data":{}}', '[{"data":{"content":[{"a":1}]}}]',
    ],
)
def test_what_is_no_document_raises(spark, tmp_path, text):
    (tmp_path / "doc.json").write_text(text)
    with pytest.raises(DocumentError):
        split_records(spark, str(tmp_path / "doc.json"))


@pytest.mark.parametrize("element", ["null", "[1]"])
def test_an_element_that_is_no_object_raises(spark, tmp_path, element):
    for text in (f'{{"data":{{"content":[{element},{{"a":1}}]}}}}', f'{{"data":{{"content":[{{"a":1}},{element}]}}}}'):
        (tmp_path / "doc.json").write_text(text)
        with pytest.raises(Exception, match="an element is no object"):
            split_records(spark, str(tmp_path / "doc.json")).collect()


def test_documents_without_records(spark, tmp_path):
    for i, text in enumerate(['{"data":{"content":[]}}', '{"data":{}}', "{}", '{"content":[{"a":1}]}']):
        (tmp_path / f"{i}.json").write_text(text)
    assert read_records(spark, str(tmp_path), split=True).count() == 0


def test_pieces_are_looked_at_once(spark, tmp_path, conf, monkeypatch):
    """The steps behind the first look neither read its table again nor hold a method
    too long for the compiler, however often the records are read."""
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"data": {"content": [{"a": "}", "b": [{}]}, {"a": 1}]}, "more": [{"c": {}}] * 3}))
    conf("spark.sql.adaptive.enabled", "false")
    sizes, save = [], Staging.save

    def saved(self, df, name, **options):
        if name == "elements":
            code = df._jdf.queryExecution().debug().codegenToSeq()
            sizes.extend(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size()))
        return save(self, df, name, **options)

    monkeypatch.setattr(Staging, "save", saved)
    found = split_records(spark, str(tmp_path))
    assert sorted(r[0] for r in found.collect()) == ['{"a": "}", "b": [{}]}', '{"a": 1}']
    assert {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in found.inputFiles()} == {"elements", "joined"}
    assert sizes and max(sizes) < 8000


def test_names_of_records_are_found_once_each(spark):
    records = spark.createDataFrame([({"b": "1", "a": None},), ({"a": "2", "b": "3"},), ({},), ({"c": "4"},), (None,)], "record MAP<STRING, STRING>")
    assert field_names(records) == ["a", "b", "c"]
