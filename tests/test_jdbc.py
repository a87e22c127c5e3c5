"""The JDBC warehouse as far as it goes without a database."""

import pytest

from starmart.sinks.warehouse import JdbcWarehouse

WAREHOUSE = JdbcWarehouse(
    "jdbc:none:db", {"user": "u", "password": "secret", "driver": "no.such.Driver"}, schema="public"
)


def test_write_options():
    assert WAREHOUSE.write_options("dim_case") == {
        "url": "jdbc:none:db",
        "user": "u",
        "password": "secret",
        "driver": "no.such.Driver",
        "dbtable": "public.dim_case",
        "numPartitions": 8,
        "batchsize": 10_000,
        "truncate": False,
    }


def test_read_options():
    assert "partitionColumn" not in WAREHOUSE.read_options("dim_case")
    split = WAREHOUSE.read_options("fact_district_daily", "id", (1, 1000))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("id", 1, 1000)
    assert split["numPartitions"] == 8
    with pytest.raises(ValueError, match="bounds"):
        WAREHOUSE.read_options("t", column="id")


def test_password_is_not_shown():
    assert "secret" not in repr(WAREHOUSE)


def test_a_missing_driver_raises(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        WAREHOUSE.load(spark, "dim_case")
    with pytest.raises(Exception, match="no.such.Driver"):
        WAREHOUSE.save(spark.range(1), "other")


def test_a_wrong_row_count_raises(spark, monkeypatch):
    """The write goes to a stand-in sink; only the count check is under test."""
    monkeypatch.setattr(JdbcWarehouse, "row_count", lambda self, spark, table: 4)
    monkeypatch.setattr(
        JdbcWarehouse, "_write", lambda self, df, table, mode: df.write.format("noop").mode("overwrite").save()
    )
    JdbcWarehouse("jdbc:none:db").save(spark.range(4), "t")
    with pytest.raises(RuntimeError, match="t holds 4 rows after a load of 3"):
        JdbcWarehouse("jdbc:none:db").save(spark.range(3), "t")
    JdbcWarehouse("jdbc:none:db", check_rows=False).save(spark.range(3), "t")
