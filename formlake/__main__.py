"""Command line: run the daily batch for a range of days, or start the landing stream.

    python -m formlake run --root LAKE --start 2026-01-05 --end 2026-01-09 [--fundamentals PARQUET]
    python -m formlake stream --root LAKE --checkpoint FOLDER [--every "1 hour"]
    python -m formlake report --root LAKE --kind elite|sells|explorer [--ticker T] [--min-score N] [--min-value V]

On a cluster: ``spark-submit --py-files formlake.zip formlake/__main__.py run ...`` (the
package is needed on the driver only: no Python code runs on the executors).
Week-end days are skipped (no daily index is published on them).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="formlake")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build all tables for a range of filing days")
    run.add_argument("--root", required=True)
    run.add_argument("--start", required=True)
    run.add_argument("--end", required=True)
    run.add_argument("--fundamentals", help="Parquet snapshot of company fundamentals")
    stream = sub.add_parser("stream", help="rebuild days as filing texts land")
    stream.add_argument("--root", required=True)
    stream.add_argument("--checkpoint", required=True, help="folder that keeps what the stream has seen")
    stream.add_argument("--fundamentals")
    stream.add_argument("--every", help="trigger interval, e.g. '1 hour'; default: process what landed, then stop")
    report = sub.add_parser("report", help="print a dashboard table from the lake as JSON lines")
    report.add_argument("--root", required=True)
    report.add_argument("--kind", choices=["elite", "sells", "explorer"], required=True)
    report.add_argument("--min-score", type=int, default=10)
    report.add_argument("--min-value", type=float, default=10_000)
    report.add_argument("--ticker", default="")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("formlake").getOrCreate()
    fundamentals_path = getattr(args, "fundamentals", None)
    fundamentals = spark.read.parquet(fundamentals_path) if fundamentals_path else None
    if args.command == "run":
        from formlake.plans.daily_batch import run_dates
        from formlake.sources.index import index_calendar

        days = [r["date"].isoformat() for r in index_calendar(spark, args.start, args.end).select("date").collect()]
        report = run_dates(spark, args.root, days, fundamentals)
        print(json.dumps({k: v for k, v in report.items() if k != "days"}, default=str))
    elif args.command == "report":
        from formlake.operators import serving_lake
        from formlake.sources.lake import has_signals

        if args.kind == "elite":
            table = serving_lake.elite_buys_from_lake(spark, args.root, min_score=args.min_score)
        elif args.kind == "sells":
            table = serving_lake.sell_rollup_from_lake(spark, args.root)
        else:
            table = serving_lake.trade_explorer_from_lake(spark, args.root, args.min_value, args.ticker or None)
        rows = table.collect()
        if not rows and args.kind != "explorer" and not has_signals(spark, args.root, "buy" if args.kind == "elite" else "sell"):
            print(json.dumps({"notice": "no signals stored yet: run the daily batch first"}))
        for row in rows:  # a top-k report: at most k rows reach the driver
            print(json.dumps(row.asDict(), default=str, ensure_ascii=False))
    else:
        from formlake.streaming import start_filings_stream

        query = start_filings_stream(
            spark, args.root, args.checkpoint, fundamentals, available_now=args.every is None, processing_time=args.every
        )
        query.awaitTermination()


if __name__ == "__main__":
    main()
