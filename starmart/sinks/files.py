"""Landing of the flat raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.names import quoted
from starmart.sources.files import CSV_LOSSLESS, STATISTICS


def land(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    sort_by: Sequence[str] = (),
    statistics: str | None = None,
    **options,
) -> None:
    """Overwrites ``path``. CSV gets a header and, unless given, the options
    with which ``read_csv`` reads every text back; a text with a line break
    raises, as CSV readers would take it for two rows.

    ``sort_by`` spreads the rows over files by the values of these columns, so
    that a filter on them skips files and row groups. Rows of one value follow a
    hash of all their columns, so a value with many rows fills several files.

    ``statistics`` names a text column: its least and greatest value by file are kept
    beside a Parquet table, so that a reader need not open files to pass over them.
    """
    if sort_by:
        names = [quoted(c) for c in df.columns]
        df = df.sort(*[F.col(quoted(c)) for c in sort_by], F.xxhash64(*names))
    if fmt == "csv":
        options = {"header": True, **CSV_LOSSLESS, **options}
        df = df.select([_one_line(f) for f in df.schema])
    df.write.mode("overwrite").options(**options).format(fmt).save(path)
    if statistics:
        _keep_statistics(df.sparkSession, path, statistics)


def _keep_statistics(spark: SparkSession, path: str, column: str) -> None:
    """A row per file with a value, from a scan of the one column."""
    landed = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col(quoted(column)).cast("string").alias("v")
    )
    stats = landed.groupBy("file").agg(F.min("v").alias("first"), F.max("v").alias("last"))
    stats.where("first IS NOT NULL").write.parquet(f"{path.rstrip('/')}/{STATISTICS}")


def _one_line(field: T.StructField):
    column = F.col(quoted(field.name))
    if not isinstance(field.dataType, T.StringType):
        return column
    message = F.lit(f"column {field.name} has a line break; land it as Parquet")
    broken = column.contains("\n") | column.contains("\r")
    return F.when(broken, F.raise_error(message)).otherwise(column).alias(field.name)
