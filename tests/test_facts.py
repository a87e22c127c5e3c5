import random
from collections import defaultdict

import pytest
from fixtures import NULL_ROWS, SMALL_RECORDS, SMALL_SPEC, raw_of, skewed_rows, small_raw
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F
from shapes import long_first_fact, rows

from starmart import CASE_SPEC, TABLES, Staging, dim_case, fact
from starmart.contracts import GEOS, conform_raw, fact_table
from starmart.functions.periods import PERIODS
from starmart.operators import lookup
from starmart.operators.totals import wide_totals
from starmart.plans.facts import all_facts

KINDS = [(g, p) for g in GEOS for p in PERIODS]


def brute_force(data, geo, period):
    """(id, place, case, period, total) by plain Python."""
    size = {"daily": slice(None), "monthly": slice(7), "yearly": slice(4)}[period]
    sums = defaultdict(lambda: None)
    for day, province, district, b, a in data:
        key = (day and day[size] if day is not None else None, {"province": province, "district": district}[geo])
        for case, value in ((1, a), (2, b)):
            old = sums[(*key, case)]
            sums[(*key, case)] = old if value is None else value + (old or 0)
    order = sorted(sums, key=lambda k: [(v is not None, v if v is not None else "") for v in k])
    return [(i, g, c, p, sums[p, g, c]) for i, (p, g, c) in enumerate(order, 1)]


@pytest.mark.parametrize("geo, period", KINDS)
@pytest.mark.parametrize("data", [NULL_ROWS, skewed_rows()], ids=["nulls", "skew"])
def test_equals_brute_force(spark, data, geo, period):
    raw = raw_of(spark, data)
    got = fact(raw, dim_case(raw, SMALL_SPEC), SMALL_SPEC, geo, period)
    assert got.schema.simpleString() == TABLES[fact_table(geo, period)].simpleString()
    assert sorted(tuple(r) for r in got.collect()) == brute_force(data, geo, period)


@pytest.mark.parametrize("geo, period", KINDS)
def test_equals_the_long_first_shape(spark, geo, period):
    raw = raw_of(spark, skewed_rows() + NULL_ROWS)
    cases = dim_case(raw, SMALL_SPEC)
    assert rows(fact(raw, cases, SMALL_SPEC, geo, period)) == rows(
        long_first_fact(raw, cases, SMALL_SPEC, geo, period)
    )


def test_golden_document(spark):
    raw = small_raw(spark)
    cases = dim_case(raw, CASE_SPEC)
    districts = fact(raw, cases, CASE_SPEC, "district", "daily").collect()
    provinces = fact(raw, cases, CASE_SPEC, "province", "daily").collect()
    assert (len(districts), len(provinces)) == (44, 22)
    first = {s: r for s, r in zip(CASE_SPEC.measures, range(11))}
    wanted = []
    for r in sorted(SMALL_RECORDS, key=lambda r: (r["tanggal"], r["kode_kab"])):
        for case, status in enumerate(CASE_SPEC.statuses, 1):
            wanted.append((len(wanted) + 1, r["kode_kab"], case, r["tanggal"], r[status]))
    assert sorted(tuple(r) for r in districts) == wanted
    august = [100 + 200 + 2 * first[s] for s in CASE_SPEC.statuses]
    september = [300 + 400 + 2 * first[s] for s in CASE_SPEC.statuses]
    assert [r.total for r in sorted(provinces)] == august + september


def test_all_facts_equal_single_facts(spark):
    raw = conform_raw(raw_of(spark, skewed_rows() + NULL_ROWS), SMALL_SPEC)
    cases = dim_case(raw, SMALL_SPEC)
    daily = wide_totals(raw, [F.col(k) for k in SMALL_SPEC.keys], SMALL_SPEC.measures)
    got = all_facts(daily, cases, SMALL_SPEC, Staging(spark))
    assert list(got) == [fact_table(g, p) for g, p in KINDS]
    for geo, period in KINDS:
        single = fact(raw, cases, SMALL_SPEC, geo, period)
        assert rows(got[fact_table(geo, period)]) == rows(single)


def test_properties(spark):
    data = [r for r in skewed_rows() if r[0]]
    random.Random(5).shuffle(data)
    raw = raw_of(spark, data)
    cases = dim_case(raw, SMALL_SPEC)
    for geo in GEOS:
        sums = []
        for period, bucket in PERIODS.items():
            df = fact(raw, cases, SMALL_SPEC, geo, period)
            place = f"{geo}_id"
            groups = df.select(bucket.column, place).distinct().count()
            ids = sorted(r.id for r in df.select("id").collect())
            assert ids == list(range(1, groups * len(SMALL_SPEC.measures) + 1))
            assert rows(df) == rows(fact(raw.repartition(7), cases, SMALL_SPEC, geo, period))
            sums.append(rows(df.groupBy(place, "case_id").agg(F.sum("total"))))
        assert sums[0] == sums[1] == sums[2]


def test_status_missing_from_the_dimension_leaves_gaps(spark):
    raw = raw_of(spark, NULL_ROWS)
    cases = dim_case(raw, SMALL_SPEC).where("status = 'b_y'")
    whole = brute_force(NULL_ROWS, "district", "daily")
    got = sorted(tuple(r) for r in fact(raw, cases, SMALL_SPEC, "district", "daily").collect())
    assert got == [r for r in whole if r[2] == 2]


@pytest.mark.parametrize("bound", [0, 10_000])
def test_lookup_beyond_the_broadcast_bound(spark, monkeypatch, bound):
    """Statuses that repeat in the dimension repeat the facts, however joined."""
    monkeypatch.setattr(lookup.broadcast_if_small, "__defaults__", (bound,))
    raw = raw_of(spark, skewed_rows())
    cases = dim_case(raw, SMALL_SPEC)
    twice = cases.unionAll(cases.withColumn("id", F.col("id") + 10))
    once = brute_force(skewed_rows(), "district", "monthly")
    both = sorted(once + [(i, g, c + 10, p, t) for i, g, c, p, t in once])
    got = fact(raw, twice, SMALL_SPEC, "district", "monthly")
    assert sorted(tuple(r) for r in got.collect()) == both
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == (2 if bound else 1)


def test_where(spark):
    raw = raw_of(spark, skewed_rows())
    cases = dim_case(raw, SMALL_SPEC)
    got = fact(raw, cases, SMALL_SPEC, "district", "daily", where=F.col("tanggal") == "2020-12-31")
    wanted = brute_force([r for r in skewed_rows() if r[0] == "2020-12-31"], "district", "daily")
    assert sorted(tuple(r) for r in got.collect()) == wanted


def test_no_rows(spark):
    raw = raw_of(spark, [])
    assert fact(raw, dim_case(raw, SMALL_SPEC), SMALL_SPEC, "province", "yearly").count() == 0


def test_overflow_raises(spark):
    raw = raw_of(spark, [("2020-01-01", "1", "1", 2**63 - 1, 1), ("2020-01-01", "1", "1", 1, 1)])
    with pytest.raises(ArithmeticException):
        fact(raw, dim_case(raw, SMALL_SPEC), SMALL_SPEC, "province", "daily").collect()
