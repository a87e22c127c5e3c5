"""Readers for the source documents and the landed raw table."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.contracts import conform_raw, raw_schema
from starmart.functions.names import quoted
from starmart.operators.flatten import RECORDS, folded
from starmart.parallel import in_parallel
from starmart.sources.split_json import split_records
from starmart.spec import StarSpec
from starmart.staging import Staging
from starmart.storage import exists, files_below, first_line

RECORD_TYPE = "MAP<STRING, STRING>"
# Where a landed table has its file statistics; readers of the table skip the name.
STATISTICS = "_days"
# Headers that are read side by side.
HEADER_READERS = 16

# Keeps NULL, '' and blanks apart. Text with line breaks needs Parquet.
CSV_LOSSLESS = {
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
}


def document_schema(spec: StarSpec) -> T.StructType:
    """Documents whose fields are spelled as in ``spec``."""
    content = T.ArrayType(raw_schema(spec))
    return T.StructType([T.StructField("data", T.StructType([T.StructField("content", content)]))])


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """JSON documents: one per line, or with ``multi_line`` one per file.

    Lines split over tasks, a multi-line file is read by one task, so large
    input should come as lines. Malformed documents and values that do not fit
    their type raise.

    Without ``schema`` all fields are found by a pass over all files and read as
    text, so that nothing is lost to a guessed type. With it that pass is
    saved, but only its fields are read, as they are spelled in it: a field in
    another spelling is NULL. ``read_records`` takes any spelling.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is None:
        return reader.option("primitivesAsString", True).json(path)
    return reader.schema(schema).json(path)


def read_records(
    spark: SparkSession,
    path: str | list[str],
    records: str = RECORDS,
    multi_line: bool = False,
    split: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """The records of JSON documents in the column ``record``: a map from field
    names, in lower case, to texts, so that no pass is needed to find the fields and
    every document may spell them in its own way. Numbers keep their digits, nested
    values are JSON texts. Documents without records give no rows. Malformed
    documents raise, and so do two fields of a record that differ by case only.

    Documents are one per line, or with ``multi_line`` one per file, read by one
    task; with ``split`` one per file, read by many (``split_records``)."""
    if split:
        texts = split_records(spark, path, records, staging)
        found = texts.select(F.from_json("record", RECORD_TYPE, {"mode": "FAILFAST"}).alias("record"))
    else:
        kind = f"ARRAY<{RECORD_TYPE}>"
        for key in reversed(records.split(".")[1:]):
            kind = f"STRUCT<{quoted(key)}: {kind}>"
        reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
        documents = reader.schema(f"{quoted(records.split('.')[0])} {kind}").json(path)
        found = documents.select(F.explode(F.col(records)).alias("record"))
    return found.select(folded(F.col("record")).alias("record"))


def header_groups(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files of a CSV source by their header line. Empty files are left out."""
    files = files_below(spark, path)
    found = in_parallel(spark, {f: partial(first_line, spark, f) for f in files}, HEADER_READERS)
    groups: dict[str, list[str]] = {}
    for file in files:
        if found[file]:
            groups.setdefault(found[file], []).append(file)
    if not groups:
        raise ValueError(f"no file has a header in {path}")
    return list(groups.values())


def _read_group(spark: SparkSession, files: list[str], sep: str, options: dict) -> DataFrame:
    options = {**CSV_LOSSLESS, "enforceSchema": False, **options}
    return spark.read.options(header=True, sep=sep, **options).csv(files)


def read_csv_text(spark: SparkSession, path: str | list[str], sep: str = ",", **options) -> DataFrame:
    """CSV with a header, every column as text. Files are read by their header, one
    scan for those with the same, and united by name; a column that a file lacks is
    NULL. The options are ``CSV_LOSSLESS`` unless given."""
    groups = [_read_group(spark, files, sep, options) for files in header_groups(spark, path)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def read_csv(
    spark: SparkSession, path: str | list[str], spec: StarSpec, sep: str = ",", **options
) -> DataFrame:
    """The raw table from CSV. Columns are taken by header name, file by file, so
    their order and further columns do not matter; a file without a declared column
    raises. Codes stay text."""
    groups = [_read_group(spark, files, sep, options) for files in header_groups(spark, path)]
    return reduce(DataFrame.unionAll, [conform_raw(g, spec, from_text=True) for g in groups])


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    spec: StarSpec,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """The raw table from Parquet. ``days`` are the first and the last day that are
    wanted: of a table that was landed with file statistics, files without any of
    them are not opened, not even for their footers."""
    paths = [path] if isinstance(path, str) else path
    if days is None:
        return conform_raw(spark.read.parquet(*paths), spec)
    files = [f for p in paths for f in files_of_days(spark, p, *days)]
    day = F.col(quoted(spec.date))
    if not files:
        return spark.createDataFrame([], raw_schema(spec))
    return conform_raw(spark.read.parquet(*files), spec).where((day >= days[0]) & (day <= days[1]))


def files_of_days(spark: SparkSession, path: str, first: str, last: str) -> list[str]:
    """The files of a landed table that may hold days from ``first`` to ``last``;
    all of them if it was landed without statistics."""
    folder = f"{path.rstrip('/')}/{STATISTICS}"
    if not exists(spark, folder):
        return [path]
    stats = spark.read.schema("file STRING, first STRING, last STRING").parquet(folder)
    held = stats.where((F.col("first") <= last) & (F.col("last") >= first)).select("file")
    return [f"{path.rstrip('/')}/{r[0]}" for r in held.sort("file").collect()]


