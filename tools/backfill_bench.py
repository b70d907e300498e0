"""End-to-end run of the daily batch over every day of a driver scale factor.

Lands one filing text per filing and one index text per day in a fresh scratch lake
(written by the executors, not through the driver), runs ``run_dates`` over all days,
and checks the stored trades against the fixture. Prints one JSON line.
Usage: python tools/backfill_bench.py [SF_DIR]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


from formlake import constants as K  # noqa: E402
from formlake.plans.daily_batch import INDEX_TEXTS, run_dates  # noqa: E402
from formlake.session import local_session  # noqa: E402
from formlake.sources import fixtures as fx  # noqa: E402
from formlake.sources import render  # noqa: E402
from formlake.sources.lake import trades_view  # noqa: E402


def land(spark, sf_dir: str, root: str) -> None:
    render.land_rendered(fx.raw_trades(spark, sf_dir), fx.index_rows(spark, sf_dir), root, INDEX_TEXTS)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="formlake-backfill-bench")
    root = tempfile.mkdtemp(prefix="formlake-lake-")
    t0 = time.perf_counter()
    land(spark, sf_dir, root)
    t_land = time.perf_counter() - t0
    days = sorted(r[0].isoformat() for r in fx.raw_trades(spark, sf_dir).select("filing_date").distinct().collect())
    t0 = time.perf_counter()
    report = run_dates(spark, root, days, fx.fundamentals_raw(spark, sf_dir))
    t_run = time.perf_counter() - t0
    stored = trades_view(spark, root)
    expected = fx.trades(spark, sf_dir)
    same = stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0
    files = sum(len(fs) for _, _, fs in os.walk(os.path.join(root, K.TABLE_FILINGS)))
    print(json.dumps({
        "sf_dir": sf_dir, "days": len(days), "filing_files": files, "land_sec": round(t_land, 2),
        "run_dates_sec": round(t_run, 2), "trades": report["trades"]["rows"],
        "buy_signals": report["buy_signals"]["rows"], "sell_signals": report["sell_signals"]["rows"],
        "enriched": report["enriched_signals"]["rows"], "index_rows": report["index"]["rows"],
        "planned_downloads": report["download_plan"]["rows"], "trades_match_fixture": same,
        "step_seconds": report.get("seconds"), "lake": root,
    }))


if __name__ == "__main__":
    main()
