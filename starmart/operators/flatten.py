"""Nested documents to flat records."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: where a document keeps its records.
RECORDS = "data.content"


def flatten_records(documents: DataFrame, records: str = RECORDS) -> DataFrame:
    """One row per array element, one lower-case column per field. Documents
    without records give no rows."""
    rows = documents.select(F.explode(F.col(records)).alias("record"))
    names = rows.schema["record"].dataType.names
    clashes = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if clashes:
        raise ValueError(f"fields differ by case only: {clashes}")
    return rows.select([F.col("record").getField(n).alias(n.lower()) for n in names])


# Far above the fields of any record, far below what a plan can hold.
MOST_FIELDS = 10_000


def folded(record: Column) -> Column:
    """A record, as a map of texts, with lower-case names. Names of one record
    that differ by case only raise."""
    names = F.transform(F.map_keys(record), lambda n: F.lower(n))
    message = F.concat(
        F.lit("fields differ by case only: "), F.array_join(F.array_sort(F.map_keys(record)), ", ")
    )
    return F.when(F.size(F.array_distinct(names)) != F.size(names), F.raise_error(message)).otherwise(
        F.map_from_arrays(names, F.map_values(record))
    )


def field_names(records: DataFrame) -> list[str]:
    """The names that occur in the maps of the column ``record``, in order. Records
    with the same names count once before these are taken apart."""
    sets = records.select(F.sort_array(F.map_keys("record")).alias("names")).distinct()
    # An inner explode would have Spark filter by the names, and parse, before other filters.
    names = sets.select(F.explode_outer("names").alias("name")).where("name IS NOT NULL").distinct()
    found = [r[0] for r in names.limit(MOST_FIELDS + 1).collect()]
    if len(found) > MOST_FIELDS:
        raise ValueError(f"the records have more than {MOST_FIELDS} different fields")
    return sorted(found)


def fields_of(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """One text column per name, NULL where a record lacks it."""
    return records.select([F.col("record")[name].alias(name) for name in names])


def having_any(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """``records``, where one with none of these fields raises: its row would be
    all NULLs. Records that are NULL or have no fields at all pass."""
    keys = F.map_keys("record")
    message = F.concat(F.lit("a record has none of the declared fields, but "), F.array_join(keys, ", "))
    unknown = (F.size(keys) > 0) & ~F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names]))
    return records.select(F.when(unknown, F.raise_error(message)).otherwise(F.col("record")).alias("record"))
