"""Facts that are kept up to date: new raw rows change the periods they touch,
and every id follows from counts.

The state of a star is totals, cut into segments. A refresh sums its raw rows by
day and place, adds the stored totals of the same days, and writes what comes out
as new segments: the days, and for each fact the periods with a touched day, each
place with its rank among the places of its period. A small table per fact says
which segment holds a period and how many places that has. The id of a row follows
from the number of places in earlier periods and its rank. The former is added up
along a tree of counts, so the rows of other periods are neither sorted nor written
again, however their ids shift.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.contracts import (
    GEOS,
    conform,
    conform_raw,
    fact_table,
    require_ansi,
    require_capacity,
)
from starmart.functions.names import quoted
from starmart.functions.periods import PERIODS
from starmart.operators.lookup import broadcast_if_small, case_lookup
from starmart.operators.numbering import POSITION, sorted_runs, with_position
from starmart.operators.totals import wide_totals
from starmart.parallel import in_parallel
from starmart.plans.dims import dim_case
from starmart.plans.facts import THREADS, geo_column, period_totals, placed_status_rows
from starmart.plans.jobs import check_dates, checked_dims
from starmart.sinks.manifest import Manifests
from starmart.sinks.warehouse import Warehouse
from starmart.spec import StarSpec
from starmart.staging import Staging
from starmart.storage import delete

DAYS = "days"
PERIOD, SEGMENT, RANK, PLACES, OFFSET = "_period", "_segment", "_rank", "_places", "_offset"
COUNTS = f"{PERIOD} STRING, {SEGMENT} STRING, {PLACES} BIGINT"
# Segments of one table beyond which a refresh makes one of them.
MOST_SEGMENTS = 16
# So few periods are looked up in the footers of files.
FEW_PERIODS = 100


def tree_offsets(counts: DataFrame) -> DataFrame:
    """``counts``, a row per period, with _offset: the places in earlier periods,
    NULL first.

    Counts are added up within months, months within years, and years. These are
    prefixes of fixed length, and of two texts the one with the lesser prefix is
    the lesser one, so this holds for texts that are no dates as well. Sums by year
    alone meet in one task.
    """
    # Never NULL, and in the same order.
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    period = F.col(PERIOD)
    days = counts.select(
        "*",
        key(F.substring(period, 1, 4)).alias("_year"),
        key(F.substring(period, 1, 7)).alias("_month"),
        key(period).alias("_day"),
    )
    earlier = lambda w, order: w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda n, w: F.coalesce(F.sum(n).over(w), F.lit(0))
    in_month = earlier(Window.partitionBy("_year", "_month"), "_day")
    in_year = earlier(Window.partitionBy("_year"), "_month")
    months = days.groupBy("_year", "_month").agg(F.sum(PLACES).alias("_n"))
    years = months.groupBy("_year").agg(F.sum("_n").alias("_n"))
    months = months.select("_year", "_month", before("_n", in_year).alias("_by_month"))
    years = years.select("_year", before("_n", earlier(Window, "_year")).alias("_by_year"))
    return (
        days.withColumn("_by_day", before(PLACES, in_month))
        .join(months, ["_year", "_month"])
        .join(years, "_year")
        .select(*counts.columns, (F.col("_by_year") + F.col("_by_month") + F.col("_by_day")).alias(OFFSET))
    )


def _in_periods(df: DataFrame, period: Column, periods: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``df`` with a table of periods, NULL like any other."""
    wanted = broadcast_if_small(periods.select(F.col(PERIOD).alias("_wanted")))
    return df.join(wanted, period.eqNullSafe(F.col("_wanted")), how)


@dataclass(frozen=True)
class _Snapshot:
    """Segments and counts of every table, as folders below the root."""

    spark: SparkSession
    spec: StarSpec
    root: str
    folders: dict[str, str]

    def schema(self, table: str) -> T.StructType:
        text, number = T.StringType(), T.LongType()
        keys = [(c, text) for c in self.spec.keys[1:]]
        for g in GEOS:
            if table.startswith(f"fact_{g}_"):
                keys = [(geo_column(g), text), (RANK, number)]
        columns = [(PERIOD, text), *keys, *[(m, number) for m in self.spec.measures], (SEGMENT, text)]
        return T.StructType([T.StructField(*c) for c in columns])

    def segments(self, table: str) -> list[str]:
        return [n.removeprefix(f"{table}/") for n in self.folders if n.startswith(f"{table}/")]

    def counts(self, table: str) -> DataFrame:
        folder = self.folders.get(f"counts/{table}")
        reader = self.spark.read.schema(COUNTS)
        return reader.parquet(f"{self.root}/{folder}") if folder else self.spark.createDataFrame([], COUNTS)

    def rows(self, table: str, owners: DataFrame) -> DataFrame:
        """The rows of the periods of ``owners``, counts or a part of them, with
        its further columns. A segment may hold older rows of a period; its
        owner tells them apart. Files without any of the periods are skipped."""
        few = owners.select(PERIOD, SEGMENT).limit(FEW_PERIODS + 1).collect()
        if len(few) > FEW_PERIODS:
            used = [r[0] for r in owners.select(SEGMENT).distinct().collect()]
            wanted = F.lit(True)
        else:
            used = sorted({r[SEGMENT] for r in few})
            wanted = F.col(PERIOD).isin([r[PERIOD] for r in few if r[PERIOD] is not None])
            if any(r[PERIOD] is None for r in few):
                wanted |= F.col(PERIOD).isNull()
        if not used:
            more = owners.drop(PERIOD, SEGMENT, PLACES).schema.fields
            return self.spark.createDataFrame([], T.StructType(self.schema(table).fields + more))
        paths = [f"{self.root}/{self.folders[f'{table}/{s}']}" for s in used]
        found = self.spark.read.schema(self.schema(table)).parquet(*paths).where(wanted)
        owner = broadcast_if_small(owners.drop(PLACES).withColumnsRenamed({PERIOD: "_owned", SEGMENT: "_owner"}))
        same = F.col(PERIOD).eqNullSafe(F.col("_owned")) & (F.col(SEGMENT) == F.col("_owner"))
        return found.join(owner, same).drop("_owned", "_owner")

    def days(self) -> DataFrame:
        """Totals by the keys of the raw table."""
        rows = self.rows(DAYS, self.counts(DAYS))
        return rows.withColumnRenamed(PERIOD, self.spec.date).select(*map(quoted, self.spec.columns))

    def facts(self) -> dict[str, DataFrame]:
        """The six facts: scans that look the offset of each period up."""
        lookup = case_lookup(dim_case(self.days(), self.spec), self.spec.statuses)
        return {fact_table(g, p): self._fact(g, p, lookup) for g in GEOS for p in PERIODS}

    def _fact(self, geo: str, period: str, lookup: DataFrame) -> DataFrame:
        table = fact_table(geo, period)
        rows = self.rows(table, tree_offsets(self.counts(table)))
        placed = rows.withColumnRenamed(PERIOD, PERIODS[period].column).withColumn(
            POSITION, F.col(OFFSET) + F.col(RANK)
        )
        long = placed_status_rows(placed, self.spec, geo, period)
        return conform(long.join(lookup, "status"), table)


@dataclass(frozen=True)
class StarState:
    """The totals of a star below ``path``, in versions: a refresh is seen whole
    or not at all, and of two at the same time the later one raises."""

    path: str
    spec: StarSpec
    keep_versions: int = 3

    @property
    def _root(self) -> str:
        return self.path.rstrip("/")

    def _snapshot(self, spark: SparkSession, number: int | None = None) -> _Snapshot:
        manifests = Manifests(spark, self._root)
        number = manifests.newest() if number is None else number
        return _Snapshot(spark, self.spec, self._root, manifests.tables(number))

    def days(self, spark: SparkSession) -> DataFrame:
        return self._snapshot(spark).days()

    def facts(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The facts of the newest version, by name."""
        return self._snapshot(spark).facts()

    def refresh(
        self,
        raw: DataFrame,
        replace_days: bool = False,
        check_keys: bool = True,
        strict_dates: bool = False,
    ) -> None:
        """Adds raw rows. With ``replace_days`` the days that occur in them lose
        their earlier rows first. Bad keys, bad dates and facts that do not fit
        raise and leave the state as it was; no rows leave it so as well."""
        spark = raw.sparkSession
        require_ansi(spark)
        manifests = Manifests(spark, self._root)
        number = manifests.newest()
        old = self._snapshot(spark, number)
        with Staging(spark) as staging:
            records = conform_raw(raw, self.spec)
            new = wide_totals(records, [F.col(quoted(c)) for c in self.spec.keys], self.spec.measures)
            new = staging.save(new, "new")
            if new.isEmpty():
                return
            check_dates(new, self.spec, strict_dates)
            draft = _Draft(old, staging, uuid.uuid4().hex)
            try:
                draft.add(new, replace_days)
                checked_dims(draft.now.days(), self.spec, staging, check_keys)
                gone = [n for n in old.folders if n not in draft.now.folders]
                manifests.publish(draft.now.folders, without=gone, after=number)
            except BaseException:
                delete(spark, f"{self._root}/{draft.folder}")
                raise
        for folder in manifests.expire(self.keep_versions):
            delete(spark, f"{self._root}/{folder}")


class _Draft:
    """A version in the making: ``now`` is what it would be if published."""

    def __init__(self, old: _Snapshot, staging: Staging, segment: str):
        self.old, self.staging, self.segment = old, staging, segment
        self.spec, self.folder = old.spec, f"_segments/{segment}"
        self.now = _Snapshot(old.spark, old.spec, old.root, dict(old.folders))

    def add(self, new: DataFrame, replace_days: bool) -> None:
        """``new`` are totals by the keys of the raw table."""
        spec = self.spec
        places = [F.col(quoted(c)) for c in spec.keys[1:]]
        days = new.select(F.col(quoted(spec.date)).alias(PERIOD), *places, *map(quoted, spec.measures))
        touched = self.staging.save(days.select(PERIOD).distinct(), "touched")
        if not replace_days:
            had = _in_periods(self.old.counts(DAYS), F.col(PERIOD), touched, "semi")
            earlier = self.old.rows(DAYS, had).select(days.columns)
            days = wide_totals(days.unionByName(earlier), [F.col(PERIOD), *places], spec.measures)
        self._write(DAYS, days)
        sizes = self.now_rows(DAYS).groupBy(PERIOD).agg(F.count(F.lit(1)).alias(PLACES))
        self._own(DAYS, self.staging.save(sizes, "sizes"))
        steps = {g: partial(self._facts, g, touched) for g in GEOS}
        in_parallel(self.staging.spark, steps, THREADS)
        for table in [DAYS, *[fact_table(g, p) for g in GEOS for p in PERIODS]]:
            self._settle(table)

    def now_rows(self, table: str) -> DataFrame:
        """What this draft wrote of a table."""
        reader = self.staging.spark.read.schema(self.now.schema(table))
        return reader.parquet(f"{self.now.root}/{self.folder}/{table}")

    def _facts(self, geo: str, days: DataFrame) -> None:
        """The touched periods of the facts of one kind of place. Months and years
        are summed from the stored days of that kind."""
        code, daily = self.spec.geo_code(geo), fact_table(geo, "daily")
        self._fact(geo, "daily", self.now_rows(DAYS), code)
        for period in PERIODS:
            if period == "daily":
                continue
            of = PERIODS[period].of
            touched = days.select(of(F.col(PERIOD)).alias(PERIOD)).distinct()
            parts = _in_periods(self.now.counts(daily), of(F.col(PERIOD)), touched, "semi")
            self._fact(geo, period, self.now.rows(daily, parts), geo_column(geo))

    def _fact(self, geo: str, period: str, source: DataFrame, code: str) -> None:
        table, column = fact_table(geo, period), PERIODS[period].column
        measures = self.spec.measures
        totals = period_totals(source, geo, period, PERIOD, code, measures)
        placed = with_position(sorted_runs(totals, [column, geo_column(geo)], self.staging, table))
        sizes = placed.groupBy(F.col(column).alias(PERIOD)).agg(
            F.min(POSITION).alias("_first"), F.count(F.lit(1)).alias(PLACES)
        )
        sizes = self.staging.save(sizes, f"{table}_sizes")
        firsts = broadcast_if_small(sizes.select(PERIOD, "_first"))
        ranked = placed.join(firsts, F.col(column).eqNullSafe(F.col(PERIOD))).select(
            PERIOD,
            geo_column(geo),
            (F.col(POSITION) - F.col("_first")).alias(RANK),
            *map(quoted, measures),
        )
        self._write(table, ranked)
        self._own(table, sizes.select(PERIOD, PLACES))

    def _write(self, table: str, rows: DataFrame) -> None:
        folder = f"{self.folder}/{table}"
        rows.withColumn(SEGMENT, F.lit(self.segment)).write.parquet(f"{self.now.root}/{folder}")
        self.now.folders[f"{table}/{self.segment}"] = folder

    def _own(self, table: str, sizes: DataFrame) -> None:
        """From now on this draft's segment holds the periods of ``sizes``."""
        others = _in_periods(self.old.counts(table), F.col(PERIOD), sizes, "anti")
        owned = sizes.select(PERIOD, F.lit(self.segment).alias(SEGMENT), PLACES)
        self._count(table, others.unionByName(owned), "counts")

    def _count(self, table: str, counts: DataFrame, name: str) -> None:
        folder = f"{self.folder}/{name}-{table}"
        counts.coalesce(1).write.parquet(f"{self.now.root}/{folder}")
        self.now.folders[f"counts/{table}"] = folder

    def _settle(self, table: str) -> None:
        """Checks the capacity, leaves out segments that hold no period any more,
        and makes one of too many: a copy, nothing is sorted."""
        counts = self.now.counts(table)
        held = {r[SEGMENT]: r["n"] for r in counts.groupBy(SEGMENT).agg(F.sum(PLACES).alias("n")).collect()}
        if table != DAYS:
            require_capacity(table, sum(held.values()) * len(self.spec.statuses))
        if len(held) > MOST_SEGMENTS:
            merged = uuid.uuid4().hex
            folder = f"{self.folder}/merged-{table}"
            rows = self.now.rows(table, counts).withColumn(SEGMENT, F.lit(merged))
            rows.write.parquet(f"{self.now.root}/{folder}")
            self.now.folders[f"{table}/{merged}"] = folder
            self._count(table, counts.withColumn(SEGMENT, F.lit(merged)), "merged-counts")
            held = {merged: 0}
        for segment in self.now.segments(table):
            if segment not in held:
                del self.now.folders[f"{table}/{segment}"]


def refresh_all(
    raw: DataFrame,
    state: StarState,
    warehouse: Warehouse,
    replace_days: bool = False,
    check_keys: bool = True,
    strict_dates: bool = False,
) -> None:
    """Adds raw rows to the state and publishes the nine tables that follow."""
    spark = raw.sparkSession
    state.refresh(raw, replace_days, check_keys, strict_dates)
    with Staging(spark) as staging:
        dims = checked_dims(state.days(spark), state.spec, staging, check_keys)
        warehouse.publish(dims | state.facts(spark))
