"""Small files and folders in whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_of(spark: SparkSession, folder: str):
    """The Hadoop path of a file or folder and its file system."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def scheme_of(spark: SparkSession, folder: str) -> str:
    """The scheme of the file system; a path without one is in the default one."""
    scheme, colon, _ = folder.partition(":")
    if colon and "/" not in scheme:
        return scheme
    return path_of(spark, folder)[1].getScheme()


def exists(spark: SparkSession, folder: str) -> bool:
    path, system = path_of(spark, folder)
    return system.exists(path)


def make_folder(spark: SparkSession, folder: str) -> None:
    path, system = path_of(spark, folder)
    system.mkdirs(path)


def delete(spark: SparkSession, folder: str) -> None:
    path, system = path_of(spark, folder)
    system.delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files and folders in a folder; none if it does not exist."""
    path, system = path_of(spark, folder)
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path)]


def read_text(spark: SparkSession, file: str) -> str:
    path, system = path_of(spark, file)
    stream = system.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, file: str, text: str, beside: str) -> bool:
    """Writes a file whole or not at all: first as ``beside``, then renamed.
    False, with nothing changed, if there is one of that name."""
    path, system = path_of(spark, file)
    draft, _ = path_of(spark, beside)
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not system.exists(path) and system.rename(draft, path):
        return True
    system.delete(draft, False)
    return False


def files_below(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that Spark would read for paths, which may be folders or patterns:
    names that begin with a dot or an underscore are left out."""
    found = []
    for pattern in [paths] if isinstance(paths, str) else paths:
        path, system = path_of(spark, pattern)
        waiting = list(system.globStatus(path) or [])
        if not waiting:
            raise FileNotFoundError(f"there is nothing at {pattern}")
        while waiting:
            status = waiting.pop()
            if status.isFile():
                found.append(status.getPath().toString())
            else:
                inside = system.listStatus(status.getPath())
                waiting += [s for s in inside if not s.getPath().getName().startswith((".", "_"))]
    return sorted(found)


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a text file, compressed or not; empty if it has none."""
    context = spark.sparkContext
    path, system = path_of(spark, file)
    codecs = context._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        context._jsc.hadoopConfiguration()
    )
    codec, stream = codecs.getCodec(path), system.open(path)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = context._jvm.java.io.InputStreamReader(plain, "UTF-8")
        return context._jvm.java.io.BufferedReader(reader).readLine() or ""
    finally:
        stream.close()
