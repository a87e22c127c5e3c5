import json

import pytest
from fixtures import SMALL_RECORDS, small_raw
from shapes import long_first_fact, rows

from starmart import CASE_SPEC, TABLES, dim_case
from starmart.__main__ import _parser, _warehouse, main
from starmart.sinks.warehouse import FileWarehouse


@pytest.fixture
def document(tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"data": {"content": SMALL_RECORDS}}, indent=1))
    return str(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_daily_run(spark, tmp_path, document, fmt):
    raw, stored = str(tmp_path / "raw"), str(tmp_path / "stored")
    main(["ingest", "--source", document, "--multi-line", "--raw", raw, "--format", fmt])
    main(["dims", "--raw", raw, "--format", fmt, "--warehouse", stored])
    main(["facts", "--raw", raw, "--format", fmt, "--warehouse", stored, "--strict-dates"])
    check(spark, stored)


def test_one_job(spark, tmp_path, document):
    raw, stored = str(tmp_path / "raw"), str(tmp_path / "stored")
    main(["create", "--warehouse", stored])
    main(["ingest", "--source", document, "--multi-line", "--raw", raw, "--by-day"])
    main(["all", "--raw", raw, "--warehouse", stored])
    check(spark, stored)


def check(spark, stored):
    warehouse, raw = FileWarehouse(stored), small_raw(spark)
    assert all(warehouse.load(spark, t).count() > 0 for t in TABLES)
    got = warehouse.load(spark, "fact_district_monthly")
    cases = dim_case(raw, CASE_SPEC)
    assert rows(got) == rows(long_first_fact(raw, cases, CASE_SPEC, "district", "monthly"))


def test_copy(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a;b\n1;2\n")
    main(["copy", "--csv", str(path), "--sep", ";", "--table", "t", "--warehouse", str(tmp_path / "w")])
    assert rows(FileWarehouse(str(tmp_path / "w")).load(spark, "t")) == [("1", "2")]


def test_connection_file(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"url": "jdbc:x", "schema": "public", "user": "u", "driver": "d"}))
    args = _parser().parse_args(["create", "--jdbc", str(path), "--truncate"])
    options = _warehouse(args).write_options("t")
    assert (options["url"], options["user"], options["dbtable"]) == ("jdbc:x", "u", "public.t")
    assert options["truncate"] is True


def test_errors_end_the_job(tmp_path, spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(["dims", "--raw", str(tmp_path / "none"), "--warehouse", str(tmp_path / "w")])
    with pytest.raises(SystemExit):
        main(["dims", "--raw", "x"])
