"""The jobs from the command line: ``python -m sessionloom etl|load|metrics|view``."""

from __future__ import annotations

import argparse

from sessionloom.columns import DATABASE, DEFAULT_GAP_MINUTES, ORDER_TYPE, TABLE, TABLE_SCHEMA
from sessionloom.operators.preview import DEFAULT_ROWS, view
from sessionloom.plans.jobs import run_etl, run_load, run_metrics
from sessionloom.session import build_session
from sessionloom.sources.staged import read_staged
from sessionloom.streaming.load import stream_load

# All columns, so that ties fall the same way each time.
STAGED_ORDER = TABLE_SCHEMA.fieldNames()


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sessionloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="raw JSON to staged files")
    etl.add_argument("source")
    etl.add_argument("target")
    etl.add_argument("--gap", type=int, default=DEFAULT_GAP_MINUTES, help="minutes")

    load = jobs.add_parser("load", help="staged files to the table")
    load.add_argument("staged")
    load.add_argument("--follow", metavar="CHECKPOINT", help="keep loading new files as they come")

    load.add_argument("--wait", type=float, metavar="SECONDS", help="wait for the staged files")

    metrics = jobs.add_parser("metrics", help="order metrics of the table as JSON")
    metrics.add_argument("--order-type", default=ORDER_TYPE)

    look = jobs.add_parser("view", help="first or last staged rows")
    look.add_argument("staged")
    look.add_argument("--side", choices=("top", "bottom"), default="top")
    look.add_argument("--rows", type=int, default=DEFAULT_ROWS)

    for job in (load, metrics):
        job.add_argument("--database", default=DATABASE)
        job.add_argument("--table", default=TABLE)
    return parser


def main() -> None:
    args = arguments().parse_args()
    spark = build_session()
    if args.job == "etl":
        run_etl(spark, args.source, args.target, args.gap)
    elif args.job == "load" and args.follow:
        stream_load(spark, args.staged, args.follow, args.database, args.table).awaitTermination()
    elif args.job == "load":
        run_load(spark, args.staged, args.database, args.table, wait=args.wait)
    elif args.job == "metrics":
        print(run_metrics(spark, args.database, args.table, args.order_type).first()[0])
    else:
        view(
            read_staged(spark, args.staged), list(STAGED_ORDER), args.side, args.rows
        ).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
