"""Run scopes and questions from the command line, in the session spark-submit provides.

    python -m starloom SCOPE ...

    ingest     SHARDS ROOT     shards to the raw table
    transform  ROOT            raw table to clean table, dimensions and fact
    full       SHARDS ROOT     both
    rank       ROOT            totals of --measure per --by, greatest first
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starloom.models import HEALTH_PLANS, ORDER_LINES
from starloom.operators.lookup import BROADCAST_BYTES
from starloom.operators.star import ranking
from starloom.plans import Layout, full_load, ingest, open_mart, report_frame, transform

STARS = {"health_plans": HEALTH_PLANS, "order_lines": ORDER_LINES}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starloom", description="Load a star schema or rank its totals.")
    parser.add_argument("--star", choices=STARS, default="health_plans")
    parser.add_argument("--format", default="parquet", help="parquet, or a format with MERGE such as delta")
    scopes = parser.add_subparsers(dest="scope", required=True)
    for scope in ("ingest", "full"):
        sub = scopes.add_parser(scope)
        sub.add_argument("shards")
        sub.add_argument("root")
        sub.add_argument("--gather", action="store_true", help="shards mix many partitions: shuffle them while ingesting")
    sub = scopes.add_parser("transform")
    sub.add_argument("root")
    sub.add_argument("--periods", nargs="*")
    sub.add_argument("--gather", action="store_true", default=None, help="write fewer and larger fact files")
    for scope in ("transform", "full"):
        own = scopes.choices[scope]
        own.add_argument("--limit-bytes", type=int, default=BROADCAST_BYTES, help="largest dimension to broadcast")
        own.add_argument("--plain-nulls", action="store_true", help="plain SQL comparison in merges")
    sub = scopes.add_parser("rank")
    sub.add_argument("root")
    sub.add_argument("--by", nargs="+", required=True)
    sub.add_argument("--measure", required=True)
    sub.add_argument("--limit", type=int)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"starloom {args.scope}").getOrCreate()
    layout = Layout(args.root, STARS[args.star], args.format)
    if args.scope == "rank":
        ranking(open_mart(spark, layout), args.by, args.measure, limit=args.limit).show(truncate=False)
        return
    if args.scope == "ingest":
        reports = [ingest(spark, layout, args.shards, gather=args.gather)]
    elif args.scope == "transform":
        reports = transform(
            spark, layout, periods=args.periods, null_safe=not args.plain_nulls, limit=args.limit_bytes, gather=args.gather
        )
    else:
        reports = full_load(
            spark, layout, args.shards, null_safe=not args.plain_nulls, limit=args.limit_bytes, gather=args.gather
        )
    report_frame(spark, reports).drop("table_schema").show(truncate=False)


if __name__ == "__main__":
    main()
