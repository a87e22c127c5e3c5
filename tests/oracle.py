"""Runs the queries and their SQL twins side by side."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def pattern(folder: str, table: str) -> str:
    path = Path(folder) / f"{table}.parquet"
    return f"{path}/*.parquet" if path.is_dir() else str(path)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{pattern(folder, table)}')"
        )
    return connection


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, all values as text."""
    frame = frame[sorted(frame.columns)].astype("object")
    frame = frame.map(lambda v: None if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v))
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def compare(spark_df, connection, sql: str) -> int:
    """Asserts equal columns, types and rows; returns the number of rows."""
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in spark_df.schema}
    assert types == {c[0]: c[1] for c in connection.execute(f"DESCRIBE {sql}").fetchall()}
    expected = ordered(connection.execute(sql).df())
    actual = ordered(spark_df.toPandas())
    pd.testing.assert_frame_equal(actual, expected)
    return len(actual)


if __name__ == "__main__":
    import time

    import __spark_entry__ as entry
    from session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    connection = connect(folder)
    for name in wanted:
        start = time.time()
        result = entry.queries()[name](spark, folder)
        rows = compare(result, connection, entry.oracle_sql()[name])
        print(f"{name}: {rows} rows equal, {time.time() - start:.2f} s", flush=True)
