"""The plans that large tables depend on."""

import re

import __spark_entry__ as entry
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmart.functions.periods import in_period
from starmart.plans.facts import period_totals
from starmart.sinks.files import land
from starmart.sources.files import files_of_days, read_parquet
from starmart.sources.shipments import SHIPMENT_SPEC, shipment_measures, shipment_records
from starmart.staging import Staging

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scan(df, table: str) -> str:
    blocks = [b for b in plan(df).split("\n\n") if f"{table}.parquet" in b]
    assert len(blocks) == 1
    return blocks[0]


def totals(spark, **kwargs):
    spec = SHIPMENT_SPEC
    raw = shipment_records(spark, FOLDER, **kwargs)
    return period_totals(raw, "district", "monthly", spec.date, spec.district_code, spec.measures)


def test_scans_read_only_what_is_used(spark):
    df = totals(spark)
    assert "l_extendedprice" not in plan(df) and "nama_prov" not in plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in scan(df, "orders")
    assert "ReadSchema: struct<n_nationkey:int,n_regionkey:int>" in scan(df, "nation")


def test_the_day_filter_reaches_the_scan(spark):
    pushed = scan(totals(spark, day=entry.DAY), "lineitem")
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,1999-06-30T00:00", pushed)
    assert re.search(r"PushedFilters: .*LessThan\(l_shipdate,1999-07-01T00:00", pushed)


def test_lines_are_never_broadcast(spark):
    df = totals(spark)
    assert "SortMergeJoin" in plan(df)
    assert "hashpartitioning(l_orderkey" in plan(df)


def test_totals_are_combined_before_the_shuffle(spark):
    text = plan(totals(spark))
    assert "partial_sum(A_F" in text and "HashAggregate" in text


def test_case_dimension_reads_no_column(spark):
    from starmart import dim_case

    df = dim_case(shipment_measures(spark, FOLDER), SHIPMENT_SPEC)
    assert "ReadSchema: struct<>" in scan(df, "lineitem")


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.CORPUS])
def test_no_python_and_no_product_in_any_plan(spark, name, monkeypatch):
    """Staged plans run before the last one and count as well."""
    texts = []
    save = Staging.save

    def seen(self, df, table):
        texts.append(plan(df))
        return save(self, df, table)

    monkeypatch.setattr(Staging, "save", seen)
    texts.append(plan(entry.queries()[name](spark, FOLDER)))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert not [t for t in texts if word in t]


def test_only_run_sizes_meet_in_one_task(spark):
    """One row per sort partition, nothing else."""
    text = plan(entry.queries()["fact_district_yearly"](spark, FOLDER))
    single = [b for b in text.split("\n\n") if "SinglePartition" in b]
    inputs = [re.search(r"Input \[\d+\]: \[(.*?)\]", b).group(1) for b in single]
    columns = sorted(re.sub(r"#\d+L?", "", i) for i in inputs)
    assert columns == ["_part, _n"]


def test_a_filter_on_the_landed_date_reaches_the_scan(spark, tmp_path):
    spec = SHIPMENT_SPEC
    shipment_records(spark, FOLDER).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw")).where(F.col("tanggal") == "1998-09-02")
    df = period_totals(raw, "district", "daily", spec.date, spec.district_code, spec.measures)
    text = plan(df)
    assert "EqualTo(tanggal,1998-09-02)" in text
    assert "nama_kab" not in re.search(r"ReadSchema: .*", text).group(0)


def test_landing_by_day_lets_a_filter_skip_files(spark, tmp_path):
    spec, day, path = SHIPMENT_SPEC, entry.DAY.isoformat(), tmp_path / "raw"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land(shipment_records(spark, FOLDER), str(path), sort_by=[spec.date])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = []
    for file in path.glob("*.parquet"):
        dates = pq.read_table(file, columns=[spec.date])[spec.date].to_pylist()
        held.append(min(dates) <= day <= max(dates))
    assert len(held) > 3 and sum(held) <= 1
    raw = read_parquet(spark, str(path), spec)
    assert raw.count() == shipment_records(spark, FOLDER).count()
    assert f"EqualTo(tanggal,{day})" in plan(raw.where(F.col(spec.date) == day))


def test_a_hot_day_fills_several_files(spark, tmp_path):
    rows = spark.range(8_000).select(F.lit("2020-01-01").alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land(rows, str(tmp_path / "hot"), sort_by=["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [pq.read_metadata(f).num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert sum(files) == 8_000 and max(files) < 3_000


def test_a_month_reaches_the_scan(spark, tmp_path):
    shipment_records(spark, FOLDER).write.parquet(str(tmp_path / "raw"))
    raw = read_parquet(spark, str(tmp_path / "raw"), SHIPMENT_SPEC)
    df = raw.where(in_period(F.col("tanggal"), "monthly", "1998-09"))
    assert "StringStartsWith(tanggal,1998-09)" in plan(df)


def test_file_statistics_pass_over_files_unopened(spark, tmp_path):
    spec, path = SHIPMENT_SPEC, str(tmp_path / "raw")
    raw = shipment_records(spark, FOLDER)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        land(raw, path, sort_by=[spec.date], statistics=spec.date)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    day = entry.DAY.isoformat()
    files = list((tmp_path / "raw").glob("*.parquet"))
    wanted = files_of_days(spark, path, day, day)
    assert len(files) > 3 and len(wanted) == 1
    for file in files:  # the others cannot be opened any more
        if file.name != wanted[0].rsplit("/", 1)[1]:
            file.write_bytes(b"no Parquet")
    found = read_parquet(spark, path, spec, days=(day, day))
    assert len(found.inputFiles()) == 1
    assert found.count() == raw.where(F.col(spec.date) == day).count() > 0
    assert read_parquet(spark, path, spec, days=("1900-01-01", "1900-12-31")).count() == 0


def test_without_statistics_all_files_are_read(spark, tmp_path):
    spec, path = SHIPMENT_SPEC, str(tmp_path / "raw")
    raw = shipment_records(spark, FOLDER)
    land(raw, path)
    days = ("1997-01-01", "1997-01-31")
    found = read_parquet(spark, path, spec, days=days)
    assert found.count() == raw.where(F.col(spec.date).between(*days)).count() > 0
