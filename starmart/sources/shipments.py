"""Order tables as a wide raw table: shipped quantities by day, nation and
return/line status take the place of case counts.

====================  =======================================================
raw column            from
====================  =======================================================
tanggal               day of ``l_shipdate``
kode_prov, nama_prov  region of the customer
kode_kab, nama_kab    nation of the customer
A_F ... R_O           ``l_quantity`` of the line with that flag and status
====================  =======================================================
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.spec import CASE_SPEC

SHIPMENT_SPEC = replace(CASE_SPEC, measures=("A_F", "A_O", "N_F", "N_O", "R_F", "R_O"))


# The columns in use, declared so that no job has to infer them.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_quantity DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _measure(name: str) -> str:
    flag, status = name.split("_")
    return (
        f"CASE WHEN l_returnflag = '{flag}' AND l_linestatus = '{status}' "
        f"THEN CAST(l_quantity AS BIGINT) END AS {name}"
    )


MEASURES = [_measure(name) for name in SHIPMENT_SPEC.measures]


def _on(day: date) -> Column:
    start = F.lit(day.isoformat()).cast("timestamp_ntz")
    end = F.lit((day + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end)


def shipment_measures(spark: SparkSession, folder: str) -> DataFrame:
    """The measures alone, for what needs no geography."""
    return _table(spark, folder, "lineitem").selectExpr(*MEASURES)


def shipment_records(spark: SparkSession, folder: str, day: date | None = None) -> DataFrame:
    """One raw row per line item. ``day`` filters in the scan.

    Line items and orders both grow with the data, so they meet in a sort-merge
    join: it spills, and adaptive execution splits a hot order. Each side is
    shuffled once, as narrow source columns; orders get their nation before.
    Nation and region come last and pass Spark's own file-size check for a
    broadcast, each as a plain scan of known size.
    """
    lines = _table(spark, folder, "lineitem")
    if day is not None:
        lines = lines.where(_on(day))
    homes = (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    return (
        lines.hint("merge")
        .join(homes, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "CAST(CAST(l_shipdate AS DATE) AS STRING) AS tanggal",
            "CAST(r_regionkey AS STRING) AS kode_prov",
            "r_name AS nama_prov",
            "CAST(n_nationkey AS STRING) AS kode_kab",
            "n_name AS nama_kab",
            *MEASURES,
        )
    )


def shipment_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows as nested documents with upper-case field names, one
    document per record, so that no group is collected."""
    records = shipment_records(spark, folder)
    record = F.struct(*[F.col(c).alias(c.upper()) for c in records.columns])
    return records.select(F.struct(F.array(record).alias("content")).alias("data"))
