import pytest
from fixtures import SMALL_SPEC
from pyspark.sql import functions as F

from starmart import CASE_SPEC, StarSpec
from starmart.functions.periods import PERIODS, date_violations, in_period
from starmart.functions.status import status_detail, status_name


def test_spec_rejects_bad_columns():
    with pytest.raises(ValueError, match="repeat"):
        StarSpec("d", "p", "pn", "k", "kn", ("A", "a"))
    with pytest.raises(ValueError, match="at least one"):
        StarSpec("d", "p", "pn", "k", "kn", ())
    with pytest.raises(ValueError, match="may not be named"):
        StarSpec("d", "p", "pn", "k", "kn", ("total",))


def test_spec_orders_statuses():
    assert SMALL_SPEC.statuses == ("a_x", "b_y")
    assert len(CASE_SPEC.statuses) == 11
    assert CASE_SPEC.statuses[0] == "closecontact_dikarantina"


def test_periods_slice_text(spark):
    dates = ["2020-08-05", "", None, "05/08/2020"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, d string")
    got = df.orderBy("i").select(*[p.of(F.col("d")) for p in PERIODS.values()]).collect()
    assert [tuple(r) for r in got] == [
        ("2020-08-05", "2020-08", "2020"),
        ("", "", ""),
        (None, None, None),
        ("05/08/2020", "05/08/2", "05/08/2020"),
    ]


def test_date_violations(spark):
    dates = ["2020-08-05", None, "", "05/08/2020", "2020-02-30", "2020-8-5", "05/08/2020"]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    assert {tuple(r) for r in date_violations(df, "d").collect()} == {
        ("", 1),
        ("05/08/2020", 2),
        ("2020-02-30", 1),
        ("2020-8-5", 1),
    }


def test_status_parts(spark):
    df = spark.createDataFrame([("abc",), ("a_b_c",), ("a_b",), (None,)], "s string")
    got = df.select("s", status_name(F.col("s")), status_detail(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [
        ("abc", "abc", None),
        ("a_b_c", "a", "b"),
        ("a_b", "a", "b"),
        (None, None, None),
    ]


def test_a_period_as_a_comparison_of_the_text(spark):
    """For all texts, dates or not, and all values."""
    texts = [None, "", "2020", "2020-", "2020-08", "2020-08-05", "2020-08x", "2020-0", "05/08/2020"]
    texts += ["2020-08-05 x", "20", "-", "é-1", "2020/08/05", "2020-080"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    values = {None, *texts, *(t[:7] for t in texts if t), *(t.split("-")[0] for t in texts if t)}
    for name, period in PERIODS.items():
        for value in values:
            slow = period.of(F.col("t")).eqNullSafe(F.lit(value))
            fast = F.coalesce(in_period(F.col("t"), name, value), F.lit(False))
            assert df.where(slow != fast).collect() == [], (name, value)
