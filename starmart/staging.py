"""Intermediate tables in the shared folder of the cluster.

A staged table cuts the lineage: what follows reads the written files, also
after executors were lost, and never runs the steps before it again.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from starmart.storage import delete, exists, make_folder, names_in, path_of, scheme_of

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders that executors were found to share with the driver, by application.
_REACHED: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. A session without it gets a
    temporary folder if it is local, the warehouse folder on a cluster, which is made
    if need be, as Spark does with a first table. There a path without a scheme is
    taken from the default file system, and the folder has to be a shared one.
    ``local-cluster`` is a cluster: each executor may have a temporary folder of its own."""
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and not local:
        folder = spark.conf.get("spark.sql.warehouse.dir", None)
        if folder and scheme_of(spark, folder) == "file":
            make_folder(spark, folder)
    if folder:
        if not local:
            require_shared(spark, folder)
        return folder.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
    return context.getCheckpointDir().rstrip("/")


def require_shared(spark: SparkSession, folder: str) -> None:
    """Raises if the folder lies in the file system of one machine: executors
    would write to their own disks, and a later read would miss those files. A path
    of the machine may be a shared mount, so files tell, not the scheme."""
    if scheme_of(spark, folder) == "file" and not _reached(spark, folder):
        raise RuntimeError(f"{folder} is on each machine's own disk; name a shared file system")


def _reached(spark: SparkSession, folder: str) -> bool:
    """Whether the driver has the folder and finds there what tasks write, one file
    per core of the cluster. Found once, that holds for the application."""
    if not os.path.isdir(urlparse(folder).path):
        return False
    context = spark.sparkContext
    known = (context.applicationId, folder)
    if known not in _REACHED:
        tasks, path = context.defaultParallelism, f"{folder.rstrip('/')}/starmart-{uuid.uuid4().hex}"
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(path)
            found = sum(name.startswith("part-") for name in names_in(spark, path))
        finally:
            delete(spark, path)
        if found != tasks:
            return False
        _REACHED.add(known)
    return True


class Staging:
    """A folder of its own for the staged tables of one job.

    Used as a context manager it drops the folder at the end. Otherwise the
    tables stay, for lazy results that still read them, until ``drop()`` or the
    end of the application, whichever comes first.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/starmart-{uuid.uuid4().hex}"
        path, system = path_of(spark, self.path)
        system.deleteOnExit(path)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
        """Writes and rereads. A table that comes back without a committed write
        raises, so that missing files cannot pass for missing rows. With
        ``drop_shuffles`` the shuffle files of the write go at its end, not when
        the driver happens to collect its garbage."""
        path = self.folder(f"{name}-{uuid.uuid4().hex[:8]}")
        before = self.spark.conf.get(CLEANUP, None)
        if drop_shuffles:
            self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if drop_shuffles:
                self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} was not committed")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete(self.spark, self.path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        self.drop()
