"""formlake: insider-transaction (Form 4) analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregates and partitioned Parquet, so one trading day and several
years of filings run through the same plan.

Layout
------
``schemas``      fixed StructTypes of every stored table
``functions``    column expressions (scores, strict number parsing, display text)
``sources``      index texts, filing texts, the Parquet lake, test fixtures
``operators``    parse, signals, enrichment, serving queries, skew-safe joins
``plans``        the daily batch (``run_dates``) and the named query registry
``streaming``    the same batch driven by Structured Streaming over landing folders
"""

__version__ = "0.1.0"

from formlake.operators.enrich import elite_count, enrich, prepare_fundamentals  # noqa: E402
from formlake.operators.ingest import download_plan, form4_counts, form4_index  # noqa: E402
from formlake.operators.parse import parse_filings  # noqa: E402
from formlake.operators.serving import (  # noqa: E402
    elite_buys,
    explorer_metrics,
    net_volume,
    price_history,
    price_overlay,
    projected_price,
    sell_rollup,
    trade_explorer,
)
from formlake.operators.serving_lake import (  # noqa: E402
    elite_buys_from_lake,
    sell_rollup_from_lake,
    trade_explorer_from_lake,
)
from formlake.operators.signals import buy_signals, score_both_sides, sell_signals, signal_counts  # noqa: E402
from formlake.plans.daily_batch import run_dates  # noqa: E402
from formlake.sources.filings import read_filings  # noqa: E402
from formlake.sources.index import index_calendar, parse_master_index, read_index_texts  # noqa: E402
from formlake.sources.lake import preview, signals_view, trades_view, write_day  # noqa: E402

__all__ = [
    "buy_signals", "download_plan", "elite_buys", "elite_buys_from_lake", "sell_rollup_from_lake",
    "trade_explorer_from_lake", "elite_count", "enrich", "explorer_metrics", "form4_counts",
    "form4_index", "index_calendar", "net_volume", "parse_filings", "parse_master_index", "prepare_fundamentals",
    "preview", "price_history", "price_overlay", "projected_price", "read_filings", "read_index_texts", "run_dates",
    "score_both_sides", "sell_rollup", "sell_signals", "signal_counts", "signals_view", "trade_explorer",
    "trades_view", "write_day",
]
