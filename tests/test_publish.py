"""All-or-nothing publication of several tables."""

import pytest
from fixtures import SMALL_SPEC, raw_of, skewed_rows
from pyspark.sql import functions as F
from shapes import rows
from test_jobs import place

from starmart import TABLES, build_all, contracts
from starmart.plans.jobs import ContractError, row_counts
from starmart.sinks.manifest import Manifests, PublishConflict
from starmart.sinks.warehouse import FileWarehouse, JdbcWarehouse
from starmart.storage import names_in


@pytest.fixture
def raw(spark):
    return raw_of(spark, place(skewed_rows()))


def contents(spark, warehouse):
    return {t: rows(warehouse.load(spark, t)) for t in TABLES}


def test_a_failure_at_any_table_leaves_the_old_version(spark, tmp_path, raw, monkeypatch):
    warehouse = FileWarehouse(str(tmp_path))
    build_all(raw, SMALL_SPEC, warehouse)
    before = contents(spark, warehouse)
    write, written = FileWarehouse._write, []

    def sixth_fails(self, df, table, folder):
        written.append(table)
        if len(written) == 6:
            df = df.withColumn(df.columns[-1], F.raise_error(F.lit("disk full")).cast("bigint"))
        write(self, df, table, folder)

    monkeypatch.setattr(FileWarehouse, "_write", sixth_fails)
    with pytest.raises(Exception, match="disk full"):
        build_all(raw.where("tanggal > '2020-12-31'"), SMALL_SPEC, warehouse)
    assert len(written) >= 6
    assert contents(spark, warehouse) == before
    assert len(names_in(spark, f"{tmp_path}/_versions")) == 1, "nothing is left behind"


def test_readers_see_one_publication(spark, tmp_path, raw):
    warehouse = FileWarehouse(str(tmp_path))
    build_all(raw, SMALL_SPEC, warehouse)
    before, pinned = contents(spark, warehouse), warehouse.pinned(spark)
    lazy = warehouse.load(spark, "fact_district_daily")
    build_all(raw.where("tanggal > '2020-12-31'"), SMALL_SPEC, warehouse)
    assert contents(spark, pinned) == before != contents(spark, warehouse)
    assert rows(lazy) == before["fact_district_daily"]
    assert {r.table_name for r in row_counts(spark, warehouse, TABLES).collect()} == set(TABLES)


def test_tables_of_other_publications_stay(spark, tmp_path):
    warehouse = FileWarehouse(str(tmp_path), keep_versions=2)
    warehouse.save(spark.range(3), "a")
    warehouse.publish({"b": spark.range(4), "c": spark.range(5)})
    for n in (6, 7, 8):
        warehouse.save(spark.range(n), "b")
    counts = {t: warehouse.load(spark, t).count() for t in "abc"}
    assert counts == {"a": 3, "b": 8, "c": 5}
    assert len(Manifests(spark, str(tmp_path)).numbers()) == 2
    held = [names_in(spark, f"{tmp_path}/_versions/{v}") for v in names_in(spark, f"{tmp_path}/_versions")]
    assert sorted(t for tables in held for t in tables if not t.startswith(".")) == ["a", "b", "b", "c"]
    warehouse.publish({})


def test_two_publications_at_a_time(spark, tmp_path, monkeypatch):
    """Another job takes the number first: its tables stay, unless ours were made
    from an older version."""
    manifests, newest = Manifests(spark, str(tmp_path)), Manifests.newest
    manifests.publish({"a": "x"})
    late = [1]
    monkeypatch.setattr(Manifests, "newest", lambda self: late.pop() if late else newest(self))
    Manifests(spark, str(tmp_path)).publish({"b": "y"})
    late.append(1)  # stale: 2 exists
    assert manifests.publish({"c": "z"}) == 3
    assert manifests.tables(3) == {"a": "x", "b": "y", "c": "z"}
    with pytest.raises(PublishConflict):
        manifests.publish({"d": "w"}, after=2)
    assert names_in(spark, manifests.folder) and not [
        n for n in names_in(spark, manifests.folder) if "draft" in n
    ]


def test_plain_folders_are_read_until_they_are_replaced(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/old")
    warehouse = FileWarehouse(str(tmp_path))
    assert warehouse.load(spark, "old").count() == 2
    warehouse.save(warehouse.load(spark, "old").union(spark.range(1)), "old")
    assert warehouse.load(spark, "old").count() == 3


def test_nothing_is_written_when_ids_do_not_fit(spark, tmp_path, raw, monkeypatch):
    rows_of_most = raw.select("tanggal", "kode_kab").distinct().count() * 2
    monkeypatch.setattr(contracts, "MOST_IDS", rows_of_most - 1)
    with pytest.raises(ContractError, match="fact_district_daily needs"):
        build_all(raw, SMALL_SPEC, FileWarehouse(str(tmp_path / "w")))
    assert not (tmp_path / "w").exists()
    monkeypatch.setattr(contracts, "MOST_IDS", rows_of_most)
    build_all(raw, SMALL_SPEC, FileWarehouse(str(tmp_path / "w")))


def test_jdbc_tables_are_staged_before_the_first_load(spark, monkeypatch):
    loaded = []
    monkeypatch.setattr(JdbcWarehouse, "_write", lambda self, df, table, mode: loaded.append(table))
    warehouse = JdbcWarehouse("jdbc:none:db", check_rows=False)
    far = spark.range(1).select(F.lit(1 << 40).alias("id"), *[F.lit("x").alias(c) for c in ("status", "status_name", "status_detail")])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        warehouse.publish({"other": spark.range(1), "dim_case": far})
    assert loaded == []
    warehouse.publish({"other": spark.range(1), "dim_case": far.withColumn("id", F.lit(1))})
    assert loaded == ["dim_case", "other"]
