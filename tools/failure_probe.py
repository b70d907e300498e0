"""Write the lake while tasks fail: the first attempt of every even partition raises.

Runs in its own session (local[4,4]: a task may be tried four times), writes the trades
of the sf0.001 fixture through ``write_day`` with failures injected into the writing
stage, computes buy signals on the written table with failures injected again, and
compares both with a failure-free computation. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def main() -> None:
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from formlake import constants as K
    from formlake.operators.signals import buy_signals
    from formlake.sources import fixtures as fx
    from formlake.sources.lake import trades_view, write_day

    @F.udf("boolean")
    def survives_first_attempt(_):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task loss")
        return True

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="formlake-failure-")
    trades = fx.trades(spark, sf)
    days = [r[0] for r in trades.select("filing_date").distinct().collect()]
    flaky = trades.filter(survives_first_attempt(F.lit(1)))
    report = write_day(flaky, root, K.TABLE_TRADES, days)
    stored = trades_view(spark, root)
    signals_flaky = buy_signals(stored.filter(survives_first_attempt(F.lit(1))))

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    tracker = spark.sparkContext.statusTracker()
    failed = 0
    for job in tracker.getJobIdsForGroup(None):
        info = tracker.getJobInfo(job)
        for stage in (info.stageIds if info else []):
            stage_info = tracker.getStageInfo(stage)
            failed += stage_info.numFailedTasks if stage_info else 0
    print(json.dumps({
        "failed_task_attempts": failed,
        "rows_written": report["rows"],
        "rows_expected": trades.count(),
        "trades_exact": same(stored, trades),
        "signals_exact": same(signals_flaky, buy_signals(trades)),
    }))


if __name__ == "__main__":
    main()
