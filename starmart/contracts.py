"""Declared schemas of the raw table and of the nine star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.functions.names import quoted
from starmart.functions.periods import PERIODS
from starmart.spec import StarSpec

# The declared names of tables, columns and keys.
GEOS = ("province", "district")


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def fact_table(geo: str, period: str) -> str:
    return f"fact_{geo}_{period}"


def _fact_schema(geo: str, period: str) -> T.StructType:
    return _schema(
        **{
            "id": T.IntegerType(),
            f"{geo}_id": T.StringType(),
            "case_id": T.IntegerType(),
            PERIODS[period].column: T.StringType(),
            "total": T.LongType(),
        }
    )


DIMS = {
    "dim_province": _schema(province_id=T.StringType(), province_name=T.StringType()),
    "dim_district": _schema(
        district_id=T.StringType(), province_id=T.StringType(), district_name=T.StringType()
    ),
    "dim_case": _schema(
        id=T.IntegerType(),
        status=T.StringType(),
        status_name=T.StringType(),
        status_detail=T.StringType(),
    ),
}

FACTS = {fact_table(g, p): _fact_schema(g, p) for g in GEOS for p in PERIODS}

TABLES = DIMS | FACTS

PRIMARY_KEYS = {
    "dim_province": ("province_id",),
    "dim_district": ("district_id",),
    "dim_case": ("id",),
}


# The largest id that the declared type of ids holds.
MOST_IDS = (1 << 31) - 1


class ContractError(ValueError):
    """A table breaks its contract."""


def require_capacity(table: str, rows: int) -> None:
    """Raises if ids from 1 to ``rows`` do not fit their declared type."""
    if rows > MOST_IDS:
        raise ContractError(f"{table} needs {rows} ids, more than an INT holds")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Column order and types of a star table. Values that do not fit raise."""
    schema = TABLES[table]
    _require(df, schema.names, table)
    return df.selectExpr(*_casts(schema))


def raw_schema(spec: StarSpec) -> T.StructType:
    """Text keys and bigint measures."""
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in spec.keys]
        + [T.StructField(c, T.LongType()) for c in spec.measures]
    )


def conform_raw(df: DataFrame, spec: StarSpec, from_text: bool = False) -> DataFrame:
    """The raw columns as declared. Integer measures of any width become bigint.
    Text measures are refused, except from a text source (``from_text``), where
    a text that is no integer raises when it is read."""
    _require(df, spec.columns, "raw table")
    if not from_text:
        kinds = {f.name.lower(): f.dataType for f in df.schema}
        wrong = {
            m: kinds[m.lower()].simpleString()
            for m in spec.measures
            if not isinstance(kinds[m.lower()], (T.IntegralType, T.NullType))
        }
        if wrong:
            raise TypeError(f"measures must be integers, got {wrong}")
    schema = raw_schema(spec)
    casts = dict(zip(schema.names, _casts(schema), strict=True))
    day = next(f.dataType for f in df.schema if f.name.lower() == spec.date.lower())
    if isinstance(day, (T.TimestampType, T.TimestampNTZType)):
        # A moment counts for its day.
        name = quoted(spec.date)
        casts[spec.date] = f"CAST(CAST({name} AS DATE) AS STRING) AS {name}"
    return df.selectExpr(*casts.values())


def conform_some(df: DataFrame, spec: StarSpec) -> DataFrame:
    """``df`` with those columns of ``spec`` that it has as declared, further ones
    as they are."""
    have = {c.lower() for c in df.columns}
    known = T.StructType([f for f in raw_schema(spec) if f.name.lower() in have])
    roles = {f.name.lower() for f in known}
    kept = [quoted(c) for c in df.columns if c.lower() not in roles]
    return df.selectExpr(*_casts(known), *kept)


def require_ansi(spark: SparkSession) -> None:
    """Jobs rely on ANSI mode: a sum that overflows, a text that is no number or
    an id that does not fit has to raise, not to become another value."""
    if str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true")


def _casts(schema: T.StructType) -> list[str]:
    return [
        f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema
    ]


def _require(df: DataFrame, names, what: str) -> None:
    have = {c.lower() for c in df.columns}
    missing = [c for c in names if c.lower() not in have]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
