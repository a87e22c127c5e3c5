from pathlib import Path

import pytest
from fixtures import NULL_ROWS, SMALL_SPEC, raw_of, skewed_rows
from shapes import long_first_fact, rows

from starmart import (
    TABLES,
    build_all,
    build_dims,
    build_facts,
    copy_csv,
    dim_case,
    dim_district,
    dim_province,
    staging,
)
from starmart.contracts import FACTS, GEOS, fact_table
from starmart.functions.periods import PERIODS
from starmart.parallel import in_parallel
from starmart.plans.jobs import ContractError, preview, row_counts
from starmart.sinks.warehouse import FileWarehouse, Warehouse
from starmart.staging import require_shared, shared_folder

CLEAN = [r for r in skewed_rows()]


def place(code):
    """Each district lies in one province."""
    return [(d, str(int(k) % 3), k, b, a) for d, _, k, b, a in code]


@pytest.fixture
def raw(spark):
    return raw_of(spark, place(CLEAN))


def staged(spark):
    root = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name for p in root.glob("starmart-*")} if root.exists() else set()


def check(spark, warehouse, raw):
    cases = dim_case(raw, SMALL_SPEC)
    assert rows(warehouse.load(spark, "dim_province")) == rows(dim_province(raw, SMALL_SPEC))
    assert rows(warehouse.load(spark, "dim_district")) == rows(dim_district(raw, SMALL_SPEC))
    assert rows(warehouse.load(spark, "dim_case")) == rows(cases)
    for geo in GEOS:
        for period in PERIODS:
            got = warehouse.load(spark, fact_table(geo, period))
            assert got.schema.simpleString() == TABLES[fact_table(geo, period)].simpleString()
            assert rows(got) == rows(long_first_fact(raw, cases, SMALL_SPEC, geo, period))


def test_build_all(spark, tmp_path, raw):
    before = staged(spark)
    warehouse = FileWarehouse(str(tmp_path))
    build_all(raw, SMALL_SPEC, warehouse, strict_dates=True)
    check(spark, warehouse, raw)
    assert staged(spark) == before


def test_two_jobs(spark, tmp_path, raw):
    before = staged(spark)
    warehouse = FileWarehouse(str(tmp_path))
    build_dims(raw, SMALL_SPEC, warehouse)
    build_facts(raw, SMALL_SPEC, warehouse)
    check(spark, warehouse, raw)
    assert staged(spark) == before


def test_a_second_run_replaces_the_first(spark, tmp_path, raw):
    warehouse = FileWarehouse(str(tmp_path))
    build_all(raw, SMALL_SPEC, warehouse)
    later = raw.where("tanggal > '2020-12-31'")
    build_all(later, SMALL_SPEC, warehouse)
    check(spark, warehouse, later)


def test_bad_keys_stop_the_job_before_any_write(spark, tmp_path, raw):
    warehouse = FileWarehouse(str(tmp_path / "w"))
    spelled = raw.unionAll(raw.replace("P1", "p1", ["nama_prov"]))
    before = staged(spark)
    with pytest.raises(ContractError, match="dim_province has bad keys.*'1'"):
        build_all(spelled, SMALL_SPEC, warehouse)
    assert not (tmp_path / "w").exists()
    assert staged(spark) == before
    build_all(spelled, SMALL_SPEC, warehouse, check_keys=False)
    check(spark, warehouse, spelled)


def test_null_keys_are_reported_or_kept(spark, tmp_path):
    raw = raw_of(spark, NULL_ROWS)
    with pytest.raises(ContractError):
        build_dims(raw, SMALL_SPEC, FileWarehouse(str(tmp_path)))
    build_all(raw, SMALL_SPEC, FileWarehouse(str(tmp_path)), check_keys=False)
    check(spark, FileWarehouse(str(tmp_path)), raw)


def test_strict_dates(spark, tmp_path):
    raw = raw_of(spark, place(CLEAN) + [("05/08/2020", "1", "1", 1, 1)])
    warehouse = FileWarehouse(str(tmp_path / "w"))
    with pytest.raises(ContractError, match="05/08/2020"):
        build_all(raw, SMALL_SPEC, warehouse, strict_dates=True)
    assert not (tmp_path / "w").exists()
    build_all(raw, SMALL_SPEC, warehouse)
    check(spark, warehouse, raw)


def test_facts_without_dims_raise(spark, tmp_path, raw):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        build_facts(raw, SMALL_SPEC, FileWarehouse(str(tmp_path / "none")))


def test_an_error_of_the_warehouse_raises(spark, raw):
    class Broken(Warehouse):
        def save(self, df, table):
            raise OSError(f"no space for {table}")

    with pytest.raises(OSError, match="no space for dim_"):
        build_all(raw, SMALL_SPEC, Broken())


def test_row_counts(spark, tmp_path, raw):
    warehouse = FileWarehouse(str(tmp_path))
    build_all(raw, SMALL_SPEC, warehouse)
    counts = {r.table_name: r.n for r in row_counts(spark, warehouse, TABLES).collect()}
    assert set(counts) == set(TABLES)
    assert counts["dim_province"] == 3 and counts["dim_case"] == 2
    for geo in GEOS:
        for period, bucket in PERIODS.items():
            table = fact_table(geo, period)
            groups = warehouse.load(spark, table).select(bucket.column, f"{geo}_id").distinct()
            assert counts[table] == 2 * groups.count()


def test_copy_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a;b\n1;032\n;x\n")
    warehouse = FileWarehouse(str(tmp_path / "w"))
    copy_csv(spark, str(path), warehouse, "copied", sep=";")
    assert rows(warehouse.load(spark, "copied")) == [(None, "x"), ("1", "032")]


def test_preview(spark, capsys):
    preview(spark.range(100), 3)
    shown = capsys.readouterr().out
    assert "only showing top 3 rows" in shown


def test_create_star_schema_keeps_what_is_there(spark, tmp_path, raw):
    warehouse = FileWarehouse(str(tmp_path))
    build_dims(raw, SMALL_SPEC, warehouse)
    warehouse.create_star_schema(spark)
    assert warehouse.load(spark, "dim_province").count() == 3
    for table in FACTS:
        df = spark.read.parquet(str(tmp_path / table))
        assert df.count() == 0 and df.schema == TABLES[table]


class Session:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, master, setting=None, folder=None):
        self.conf = self.sparkContext = self
        self.master, self.setting, self.folder = master, setting, folder

    def get(self, key, default):
        return self.setting if key == "spark.checkpoint.dir" and self.setting else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark):
    with pytest.raises(RuntimeError, match="own disk"):
        shared_folder(Session("yarn", "file:///x"))
    with pytest.raises(RuntimeError, match="own disk"):
        require_shared(spark, "/x")  # the default file system of this session


def test_a_mounted_folder_is_taken_if_the_files_of_all_tasks_arrive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    require_shared(spark, str(tmp_path))
    require_shared(spark, f"file://{tmp_path}")
    assert list(tmp_path.iterdir()) == []
    (tmp_path / "other").mkdir()
    monkeypatch.setattr(staging, "names_in", lambda spark, folder: ["part-00000"])
    with pytest.raises(RuntimeError, match="own disk"):
        require_shared(spark, f"{tmp_path}/other")
    assert list((tmp_path / "other").iterdir()) == []


def test_a_cluster_without_a_checkpoint_folder_uses_the_warehouse():
    class WithWarehouse(Session):
        def get(self, key, default):
            return "hdfs://shared/wh/" if key == "spark.sql.warehouse.dir" else super().get(key, default)

    assert shared_folder(WithWarehouse("yarn")) == "hdfs://shared/wh"
    assert shared_folder(WithWarehouse("yarn", "hdfs://shared/dir")) == "hdfs://shared/dir"


class Unset:
    """A session on another master and without ``spark.checkpoint.dir``."""

    def __init__(self, spark, master, warehouse):
        self.spark, self.warehouse, self.conf = spark, warehouse, self
        self.sparkContext = Context(spark.sparkContext, master)

    def get(self, key, default=None):
        return self.warehouse if key == "spark.sql.warehouse.dir" else default

    def __getattr__(self, name):
        return getattr(self.spark, name)


class Context:
    def __init__(self, context, master):
        self.context, self.master = context, master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        raise AssertionError("a temporary folder of the driver")

    def __getattr__(self, name):
        return getattr(self.context, name)


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_warehouse_folder_that_no_table_has_made_yet_is_taken(spark, tmp_path, master):
    session = Unset(spark, master, f"file:{tmp_path}/warehouse")
    assert shared_folder(session) == f"file:{tmp_path}/warehouse"
    assert list((tmp_path / "warehouse").iterdir()) == []


def test_a_staged_table_can_drop_its_shuffles(spark):
    def shuffled():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*.data")}

    with staging.Staging(spark) as held:
        before, setting = shuffled(), spark.conf.get(staging.CLEANUP, None)
        saved = held.save(spark.range(1000).repartition("id"), "rows", drop_shuffles=True)
        assert not shuffled() - before and saved.count() == 1000
        assert spark.conf.get(staging.CLEANUP, None) == setting


def test_shared_folder_comes_from_the_session():
    assert shared_folder(Session("yarn", "hdfs://shared/dir/", "hdfs://other")) == "hdfs://shared/dir"
    assert shared_folder(Session("yarn", folder="hdfs://other")) == "hdfs://other"


def test_only_a_local_session_gets_a_temporary_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.folder


def test_in_parallel_raises_the_first_error(spark):
    assert in_parallel(spark, {"a": lambda: 1, "b": lambda: 2}, 2) == {"a": 1, "b": 2}
    with pytest.raises(ZeroDivisionError):
        in_parallel(spark, {"a": lambda: 1 / 0, "b": lambda: 2}, 1)
