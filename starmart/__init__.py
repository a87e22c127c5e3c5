"""Star-schema analytics over wide case records, on Spark DataFrames."""

from starmart.contracts import TABLES, conform, conform_raw, raw_schema
from starmart.plans.dims import dim_case, dim_district, dim_province
from starmart.plans.facts import fact
from starmart.plans.jobs import build_all, build_dims, build_facts, copy_csv, ingest
from starmart.plans.refresh import StarState, refresh_all
from starmart.spec import CASE_SPEC, StarSpec
from starmart.staging import Staging

__all__ = [
    "CASE_SPEC",
    "StarSpec",
    "StarState",
    "Staging",
    "TABLES",
    "build_all",
    "build_dims",
    "build_facts",
    "conform",
    "conform_raw",
    "copy_csv",
    "dim_case",
    "dim_district",
    "dim_province",
    "fact",
    "ingest",
    "raw_schema",
    "refresh_all",
]
