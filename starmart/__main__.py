"""The jobs from the command line, for spark-submit and for any scheduler:

    python -m starmart ingest --source docs.json --multi-line --raw /lake/raw
    python -m starmart dims --raw /lake/raw --warehouse /warehouse
    python -m starmart facts --raw /lake/raw --warehouse /warehouse
    python -m starmart all --raw /lake/raw --jdbc connection.json
    python -m starmart refresh --raw /lake/new --state /lake/state --warehouse /warehouse

``connection.json`` holds ``url`` and JDBC properties such as user, password and
driver, and optionally ``schema``. A job that fails ends with an error code.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from starmart.plans.jobs import build_all, build_dims, build_facts, copy_csv, ingest
from starmart.plans.refresh import StarState, refresh_all
from starmart.sinks.warehouse import FileWarehouse, JdbcWarehouse, Warehouse
from starmart.sources.files import document_schema, read_csv, read_parquet
from starmart.spec import CASE_SPEC


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starmart")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="JSON documents to a flat raw table")
    job.add_argument("--source", required=True)
    job.add_argument("--raw", required=True)
    job.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    job.add_argument("--multi-line", action="store_true", help="one document per file")
    job.add_argument("--split", action="store_true", help="one document per file, read by many tasks")
    job.add_argument("--declared", action="store_true", help="land the declared fields alone")
    job.add_argument("--partitions", type=int)
    job.add_argument("--by-day", action="store_true", help="land in the order of days")

    for name in ("dims", "facts", "all", "refresh"):
        job = jobs.add_parser(name, help="raw table to warehouse tables")
        if name == "refresh":
            job.add_argument("--state", required=True, help="folder of the totals so far")
            job.add_argument(
                "--replace-days", action="store_true", help="new rows replace those of their days"
            )
        job.add_argument("--raw", required=True)
        job.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        job.add_argument("--no-key-check", action="store_true")
        if name != "dims":
            job.add_argument("--strict-dates", action="store_true")
        _add_warehouse(job)

    job = jobs.add_parser("copy", help="CSV file to a warehouse table of text columns")
    job.add_argument("--csv", required=True)
    job.add_argument("--sep", default=",")
    job.add_argument("--table", required=True)
    _add_warehouse(job)

    _add_warehouse(jobs.add_parser("create", help="make the missing star tables"))
    return parser


def _add_warehouse(job: argparse.ArgumentParser) -> None:
    where = job.add_mutually_exclusive_group(required=True)
    where.add_argument("--warehouse", help="folder of Parquet tables")
    where.add_argument("--jdbc", help="JSON file with the connection")
    job.add_argument("--truncate", action="store_true", help="keep JDBC table definitions")
    job.add_argument("--connections", type=int, help="JDBC connections of a load")
    job.add_argument("--batch-rows", type=int, help="rows of a JDBC batch")
    job.add_argument("--no-row-check", action="store_true", help="do not count rows after a JDBC load")


def _warehouse(args: argparse.Namespace) -> Warehouse:
    if args.warehouse:
        return FileWarehouse(args.warehouse)
    with open(args.jdbc, encoding="utf-8") as file:
        connection = json.load(file)
    given = {"connections": args.connections, "batch_rows": args.batch_rows}
    return JdbcWarehouse(
        connection.pop("url"),
        schema=connection.pop("schema", None),
        properties=connection,
        truncate=args.truncate,
        check_rows=not args.no_row_check,
        **{name: value for name, value in given.items() if value is not None},
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"starmart {args.job}").getOrCreate()
    if args.job == "ingest":
        schema = document_schema(CASE_SPEC) if args.declared else None
        ingest(
            spark,
            args.source,
            args.raw,
            schema,
            multi_line=args.multi_line,
            partitions=args.partitions,
            fmt=args.format,
            spec=CASE_SPEC,
            by_day=args.by_day,
            split=args.split,
        )
        return
    warehouse = _warehouse(args)
    if args.job == "create":
        warehouse.create_star_schema(spark)
    elif args.job == "copy":
        copy_csv(spark, args.csv, warehouse, args.table, args.sep)
    else:
        read = {"parquet": read_parquet, "csv": read_csv}[args.format]
        raw = read(spark, args.raw, CASE_SPEC)
        if args.job == "dims":
            build_dims(raw, CASE_SPEC, warehouse, check_keys=not args.no_key_check)
        elif args.job == "facts":
            build_facts(
                raw,
                CASE_SPEC,
                warehouse,
                strict_dates=args.strict_dates,
                check_keys=not args.no_key_check,
            )
        elif args.job == "refresh":
            refresh_all(
                raw,
                StarState(args.state, CASE_SPEC),
                warehouse,
                replace_days=args.replace_days,
                check_keys=not args.no_key_check,
                strict_dates=args.strict_dates,
            )
        else:
            build_all(
                raw,
                CASE_SPEC,
                warehouse,
                check_keys=not args.no_key_check,
                strict_dates=args.strict_dates,
            )


if __name__ == "__main__":
    main()
