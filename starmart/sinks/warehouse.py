"""Where the star tables live: a folder of Parquet tables or a JDBC database."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from starmart.contracts import DIMS, TABLES, conform
from starmart.parallel import in_parallel
from starmart.sinks.manifest import Manifests
from starmart.staging import Staging
from starmart.storage import delete


class Warehouse:
    """Overwrites and reads tables by name. Star tables are cast to their
    declared schema, other tables are taken as they are."""

    # Tables that may be written side by side.
    writers = 1

    def save(self, df: DataFrame, table: str) -> None:
        raise NotImplementedError

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        raise NotImplementedError

    def create_if_absent(self, spark: SparkSession, table: str) -> None:
        raise NotImplementedError

    def publish(self, tables: dict[str, DataFrame]) -> None:
        """Overwrites several tables, dimensions first, as facts refer to them."""
        _in_order(tables, self.save, self.writers)

    def pinned(self, spark: SparkSession) -> Warehouse:
        """The warehouse as it is now, where later publications do not show."""
        return self

    def create_star_schema(self, spark: SparkSession) -> None:
        """Makes the missing star tables, empty, with their declared schema."""
        for table in TABLES:
            self.create_if_absent(spark, table)


def _declared(df: DataFrame, table: str) -> DataFrame:
    return conform(df, table) if table in TABLES else df


def _in_order(
    tables: dict[str, DataFrame], write: Callable[[DataFrame, str], None], writers: int
) -> None:
    for group in ([t for t in tables if t in DIMS], [t for t in tables if t not in DIMS]):
        if group:
            writes = {t: partial(write, tables[t], t) for t in group}
            in_parallel(tables[group[0]].sparkSession, writes, writers)


@dataclass(frozen=True)
class FileWarehouse(Warehouse):
    """Parquet tables below ``path``.

    A publication writes its tables into folders of their own and then makes
    them current, all at once, by a new manifest. Up to then, and if anything
    fails, readers see the tables as they were. Every table keeps the folder of
    its last publication; folders that none of the newest ``keep_versions``
    manifests names are removed, so a reader may go on for that many
    publications. ``version`` is the number of the manifest to read, the newest
    if None. A table that no manifest names is a folder of its name.
    """

    path: str
    version: int | None = None
    keep_versions: int = 3

    writers = 4

    @property
    def _root(self) -> str:
        return self.path.rstrip("/")

    def _folder(self, spark: SparkSession, table: str) -> str:
        manifests = Manifests(spark, self._root)
        number = manifests.newest() if self.version is None else self.version
        return f"{self._root}/{manifests.tables(number).get(table, table)}"

    def _write(self, df: DataFrame, table: str, folder: str) -> None:
        _declared(df, table).write.parquet(folder)

    def save(self, df: DataFrame, table: str) -> None:
        self.publish({table: df})

    def publish(self, tables: dict[str, DataFrame]) -> None:
        if not tables:
            return
        spark = next(iter(tables.values())).sparkSession
        version = f"_versions/{uuid.uuid4().hex}"
        folders = {t: f"{version}/{t}" for t in tables}
        try:
            writes = {
                t: partial(self._write, df, t, f"{self._root}/{folders[t]}")
                for t, df in tables.items()
            }
            in_parallel(spark, writes, self.writers)
        except BaseException:
            delete(spark, f"{self._root}/{version}")
            raise
        manifests = Manifests(spark, self._root)
        manifests.publish(folders)
        for folder in manifests.expire(self.keep_versions):
            delete(spark, f"{self._root}/{folder}")

    def pinned(self, spark: SparkSession) -> FileWarehouse:
        return replace(self, version=Manifests(spark, self._root).newest())

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.schema(TABLES[table]) if table in TABLES else spark.read
        return reader.parquet(self._folder(spark, table))

    def create_if_absent(self, spark: SparkSession, table: str) -> None:
        empty = spark.createDataFrame([], TABLES[table])
        empty.write.mode("ignore").parquet(self._folder(spark, table))


@dataclass(frozen=True)
class JdbcWarehouse(Warehouse):
    """Tables of a database. Address and credentials come from the caller;
    ``properties`` holds user, password, driver and further JDBC options.

    ``connections`` bounds the concurrent writers. With ``truncate`` an
    overwrite keeps the table definition and with it keys and column types;
    without, Spark makes the table anew from the declared schema.

    A write task that is run again after its first run was committed would
    double its rows. ``check_rows`` therefore compares row counts after a load.

    Rows are staged before they are loaded, those of one publication all before
    the first load: a value that does not fit stops it while the database is
    as it was, and no plan runs twice or in as few tasks as there are connections.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    schema: str | None = None
    connections: int = 8
    batch_rows: int = 10_000
    truncate: bool = False
    check_rows: bool = True

    # Tables that may be staged side by side.
    stagers = 4

    def _name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def _options(self) -> dict[str, Any]:
        return {"url": self.url, **self.properties}

    def write_options(self, table: str) -> dict[str, Any]:
        """Options given in ``properties`` win over the fields of this class."""
        return {
            "numPartitions": self.connections,
            "batchsize": self.batch_rows,
            "truncate": self.truncate,
            **self._options(),
            "dbtable": self._name(table),
        }

    def read_options(
        self,
        table: str,
        column: str | None = None,
        bounds: tuple[Any, Any] | None = None,
    ) -> dict[str, Any]:
        """With ``column`` and its ``bounds`` the scan is split over
        ``connections`` tasks; rows outside the bounds are read as well."""
        if (column is None) != (bounds is None):
            raise ValueError("a split scan needs both a column and its bounds")
        options = {**self._options(), "dbtable": self._name(table)}
        if column is not None:
            options |= {
                "partitionColumn": column,
                "lowerBound": bounds[0],
                "upperBound": bounds[1],
                "numPartitions": self.connections,
            }
        return options

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        options = self.write_options(table)
        # Spark would coalesce to numPartitions, and all that comes before the
        # load would run in so few tasks.
        spread = df.repartition(int(options["numPartitions"]))
        spread.write.format("jdbc").options(**options).mode(mode).save()

    def _reader(self, spark: SparkSession) -> DataFrameReader:
        return spark.read.format("jdbc")

    def save(self, df: DataFrame, table: str) -> None:
        self.publish({table: df})

    def publish(self, tables: dict[str, DataFrame]) -> None:
        if not tables:
            return
        spark = next(iter(tables.values())).sparkSession
        with Staging(spark) as staging:
            saves = {t: partial(staging.save, _declared(df, t), t) for t, df in tables.items()}
            _in_order(in_parallel(spark, saves, self.stagers), self._replace, self.writers)

    def _replace(self, staged: DataFrame, table: str) -> None:
        self._write(staged, table, "overwrite")
        if self.check_rows:
            wanted, found = staged.count(), self.row_count(staged.sparkSession, table)
            if wanted != found:
                raise RuntimeError(f"{table} holds {found} rows after a load of {wanted}")

    def load(
        self,
        spark: SparkSession,
        table: str,
        column: str | None = None,
        bounds: tuple[Any, Any] | None = None,
    ) -> DataFrame:
        df = self._reader(spark).options(**self.read_options(table, column, bounds)).load()
        return _declared(df, table)

    def row_count(self, spark: SparkSession, table: str) -> int:
        """Counted by the database."""
        query = f"SELECT count(*) AS n FROM {self._name(table)}"
        return int(self._reader(spark).options(**self._options(), query=query).load().first()[0])

    def create_if_absent(self, spark: SparkSession, table: str) -> None:
        self._write(spark.createDataFrame([], TABLES[table]), table, "ignore")
