"""Small invented inputs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from starmart import CASE_SPEC, StarSpec, raw_schema

SMALL_SPEC = StarSpec("tanggal", "kode_prov", "nama_prov", "kode_kab", "nama_kab", ("b_y", "a_x"))


def record(day: str, code: str, name: str, first: int) -> dict:
    """The measures count up from ``first`` in the order of the spec."""
    return {
        "tanggal": day,
        "kode_prov": "32",
        "nama_prov": "West",
        "kode_kab": code,
        "nama_kab": name,
        **{m: first + i for i, m in enumerate(CASE_SPEC.measures)},
    }


SMALL_RECORDS = [
    record("2020-08-05", "3201", "North", 100),
    record("2020-08-05", "3202", "South", 200),
    record("2020-09-01", "3201", "North", 300),
    record("2020-09-01", "3202", "South", 400),
]


def small_raw(spark: SparkSession) -> DataFrame:
    schema = raw_schema(CASE_SPEC)
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in SMALL_RECORDS], schema)


def raw_of(spark: SparkSession, data: list[tuple]) -> DataFrame:
    """Rows of (date, province, district, b_y, a_x)."""
    full = [(d, p, p and f"P{p}", k, k and f"K{k}", b, a) for d, p, k, b, a in data]
    return spark.createDataFrame(full, raw_schema(SMALL_SPEC))


NULL_ROWS = [
    ("2020-08-05", "1", "10", 5, None),
    ("2020-08-05", "1", "10", 7, None),
    ("2020-08-05", "1", None, 1, 2),
    ("2020-08-06", None, None, None, None),
    (None, "1", "10", 3, 4),
    (None, None, None, 8, None),
    ("", "2", "20", 9, 9),
    ("2021-01-01", "2", "20", 0, -4),
]


def skewed_rows(days: int = 12, places: int = 60) -> list[tuple]:
    """One day and one district each hold a third of all rows."""
    start = date(2020, 12, 25)
    data = []
    for i in range(places):
        data.append(("2020-12-31", str(i % 7), str(i), i, None))
        data.append(((start + timedelta(days=i % days)).isoformat(), "3", "7", None, i))
        data.append(((start + timedelta(days=i % days)).isoformat(), str(i % 7), str(i * 31 % 97), 1, 1))
    return data
