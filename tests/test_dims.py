from fixtures import NULL_ROWS, SMALL_SPEC, raw_of, small_raw
from shapes import rows

from starmart import CASE_SPEC, StarSpec, dim_case, dim_district, dim_province
from starmart.contracts import TABLES

# The case dimension of the source's measures.
GOLDEN_CASES = [
    (1, "closecontact_dikarantina", "closecontact", "dikarantina"),
    (2, "closecontact_discarded", "closecontact", "discarded"),
    (3, "closecontact_meninggal", "closecontact", "meninggal"),
    (4, "confirmation_meninggal", "confirmation", "meninggal"),
    (5, "confirmation_sembuh", "confirmation", "sembuh"),
    (6, "probable_diisolasi", "probable", "diisolasi"),
    (7, "probable_discarded", "probable", "discarded"),
    (8, "probable_meninggal", "probable", "meninggal"),
    (9, "suspect_diisolasi", "suspect", "diisolasi"),
    (10, "suspect_discarded", "suspect", "discarded"),
    (11, "suspect_meninggal", "suspect", "meninggal"),
]


def test_dim_case(spark):
    got = dim_case(small_raw(spark), CASE_SPEC)
    assert got.schema.simpleString() == TABLES["dim_case"].simpleString()
    assert sorted(tuple(r) for r in got.collect()) == GOLDEN_CASES


def test_dim_case_of_no_rows(spark):
    assert dim_case(small_raw(spark).where("false"), CASE_SPEC).count() == 0


def test_dim_case_status_without_detail(spark):
    spec = StarSpec("tanggal", "kode_prov", "nama_prov", "kode_kab", "nama_kab", ("abc", "a_b_c"))
    raw = spark.range(1)
    assert sorted(tuple(r) for r in dim_case(raw, spec).collect()) == [
        (1, "a_b_c", "a", "b"),
        (2, "abc", "abc", None),
    ]


def test_dim_province_and_district(spark):
    raw = small_raw(spark)
    assert rows(dim_province(raw, CASE_SPEC)) == [("32", "West")]
    assert rows(dim_district(raw, CASE_SPEC)) == [("3201", "32", "North"), ("3202", "32", "South")]


def test_dims_keep_nulls_and_spellings(spark):
    raw = raw_of(spark, NULL_ROWS)
    assert rows(dim_province(raw, SMALL_SPEC)) == [(None, None), ("1", "P1"), ("2", "P2")]
    again = raw.unionAll(raw.replace("P1", "p1", ["nama_prov"]))
    assert rows(dim_province(again, SMALL_SPEC)) == [
        (None, None),
        ("1", "P1"),
        ("1", "p1"),
        ("2", "P2"),
    ]
