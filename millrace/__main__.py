"""Command line for the three jobs: ``spark-submit -m millrace extract ...``.

Master, memory and the JDBC driver's jar belong to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace import jobs
from millrace.scratch import fresh_path
from millrace.sinks.files import CODECS
from millrace.sinks.jdbc import BATCH_ROWS, IF_EXISTS

# Environment variables that stand in for missing arguments.
ENVIRONMENT = {
    "server": "SQL_SERVER",
    "database": "SQL_DATABASE",
    "username": "SQL_USERNAME",
    "password": "SQL_PASSWORD",
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace")
    commands = parser.add_subparsers(dest="command", required=True)

    server = argparse.ArgumentParser(add_help=False)
    for name, variable in ENVIRONMENT.items():
        server.add_argument(f"--{name}", default=os.environ.get(variable), help=f"or {variable}")

    extract = commands.add_parser("extract", parents=[server], help="database to Parquet")
    extract.add_argument("--table")
    extract.add_argument("--query", help="wins over --table")
    extract.add_argument("--output-path", required=True)
    extract.add_argument("--compression", default="snappy", help=f"one of {', '.join(CODECS)}")
    extract.add_argument("--partition-by", nargs="+", default=[])
    extract.add_argument("--split-column", help="number or date column for a parallel read")
    extract.add_argument("--splits", type=int, default=1)

    analyze = commands.add_parser("analyze", help="SQL over Parquet")
    analyze.add_argument("--parquet-path", required=True)
    analyze.add_argument("--table-name", required=True)
    analyze.add_argument("--query", required=True)
    analyze.add_argument("--column", help="also count the values of this column")
    analyze.add_argument("--save-results", action="store_true")
    analyze.add_argument("--output-dir")

    restore = commands.add_parser("restore", parents=[server], help="Parquet to database")
    restore.add_argument("--parquet-path", required=True)
    restore.add_argument("--table-name", required=True)
    restore.add_argument("--schema")
    restore.add_argument("--if-exists", choices=sorted(IF_EXISTS), default="fail")
    restore.add_argument("--batch-size", type=int, default=BATCH_ROWS)
    restore.add_argument("--transform-query", help="SQL over parquet_view")
    return parser


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command == "extract" and not (args.table or args.query):
        parser.error("give --table or --query")
    if args.command == "analyze" and args.save_results and not args.output_dir:
        parser.error("--save-results needs --output-dir")
    missing = [n for n in ENVIRONMENT if hasattr(args, n) and not getattr(args, n)]
    if missing:
        parser.error(f"missing --{missing[0]} (or {ENVIRONMENT[missing[0]]})")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "analyze":
        folder = args.output_dir if args.save_results else fresh_path(spark, "analyze")
        result, counts = jobs.analyze(
            spark, args.parquet_path, args.table_name, args.query, column=args.column, save_to=folder
        )
        print(f"analyze: {result.count()} rows in {folder}/result")
        if counts is not None:
            print(f"analyze: {counts.count()} values in {folder}/values/{args.column}")
        return
    url, properties = jobs.sql_server(args.server, args.database, args.username, args.password)
    if args.command == "extract":
        rows = jobs.extract(
            spark,
            url,
            properties,
            args.output_path,
            table=args.table,
            query=args.query,
            codec=args.compression,
            partition_by=args.partition_by,
            partition_column=args.split_column,
            partitions=args.splits,
        )
    else:
        rows = jobs.restore(
            spark,
            args.parquet_path,
            url,
            properties,
            f"{args.schema}.{args.table_name}" if args.schema else args.table_name,
            transform=args.transform_query,
            if_exists=args.if_exists,
            batch_rows=args.batch_size,
        )
    print(f"{args.command}: {rows} rows")


if __name__ == "__main__":
    given = arguments()
    run(SparkSession.builder.appName(f"millrace {given.command}").getOrCreate(), given)
