"""Day, month and year of a ``yyyy-MM-dd`` text. These are slices of the text:
nothing is parsed, so a date in another form is kept as its slice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(date: Column) -> Column:
    return date


def month(date: Column) -> Column:
    return F.substring(date, 1, 7)


def year(date: Column) -> Column:
    return F.get(F.split(date, "-"), 0)


@dataclass(frozen=True)
class Period:
    column: str
    of: Callable[[Column], Column]


PERIODS = {
    "daily": Period("date", day),
    "monthly": Period("month", month),
    "yearly": Period("year", year),
}


def in_period(date: Column, period: str, value: str | None) -> Column:
    """Whether the period of a date text is ``value``, as a comparison of the text
    itself, which a scan can use to skip files. Equal to ``PERIODS[period].of(date) ==
    value`` for every text, dates or not; NULL is in the period NULL."""
    if value is None:
        return date.isNull()
    if period == "daily":
        return date == value
    if period == "monthly":  # a shorter text is its own month
        return date.startswith(value) if len(value) == 7 else (date == value) & F.lit(len(value) < 7)
    return ((date == value) | date.startswith(f"{value}-")) & F.lit("-" not in value)


def date_violations(df: DataFrame, date: str) -> DataFrame:
    """The texts that are no ``yyyy-MM-dd`` day, with their row counts."""
    text = F.col(date).cast("string")
    is_day = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    return (
        df.where(text.isNotNull() & ~is_day)
        .groupBy(text.alias(date))
        .agg(F.count(F.lit(1)).alias("n"))
    )
