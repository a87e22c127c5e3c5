"""Parts of a status such as ``suspect_discarded``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def status_name(status: Column) -> Column:
    return F.get(F.split(status, "_"), 0)


def status_detail(status: Column) -> Column:
    """The second part, NULL if there is none; further parts are dropped."""
    return F.get(F.split(status, "_"), 1)
