"""Named queries over the driver tables: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame built only from the tables in
``sf_dir`` (through the derivations in ``formlake.sources.fixtures``), over all of
their rows. Parameters are the reference defaults; where an operator takes a user
input (a ticker, an as-of date) the query binds a fixed example value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake import constants as K
from formlake.functions import display, scores
from formlake.operators import enrich as E
from formlake.operators import ingest, parse, serving
from formlake.operators.joins import with_own_lookups
from formlake.operators import signals as S
from formlake.session import scratch_path, staging
from formlake.plans.daily_batch import run_dates
from formlake.sources import fixtures as fx
from formlake.sources import lake, render
from formlake.sources.filings import read_filings
from formlake.sources.index import calendar_between, parse_master_index

# example user inputs of the chart views
EXAMPLE_TICKER = "BRAND13"
EXAMPLE_AS_OF = "2001-08-01"
# landing root used by the download plan (only strings are built; nothing is read)
EXAMPLE_ROOT = "/data/lake"

Query = Callable[[SparkSession, str], DataFrame]


def _scored_both_sides(spark: SparkSession, sf: str) -> DataFrame:
    return S.score_both_sides(fx.trades(spark, sf))


def _buys(spark, sf):
    return S.buy_signals(fx.trades(spark, sf))


def _sells(spark, sf):
    return S.sell_signals(fx.trades(spark, sf))


def _fundamentals(spark, sf):
    return E.prepare_fundamentals(fx.fundamentals_raw(spark, sf))


def _enriched(spark, sf):
    return E.enrich(_buys(spark, sf), _fundamentals(spark, sf))


def q_index_calendar(spark, sf):
    orders = fx.table(spark, sf, "orders")
    bounds = orders.agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return calendar_between(bounds)


def q_master_index(spark, sf):
    return parse_master_index(render.render_index_texts(fx.index_rows(spark, sf)))


def q_form4_index(spark, sf):
    return ingest.form4_index(render.render_index_texts(fx.index_rows(spark, sf)))


def q_download_plan(spark, sf):
    f4 = ingest.form4_index(render.render_index_texts(fx.index_rows(spark, sf)), with_run_date=True)
    return ingest.download_plan(f4, fx.landed_files(spark, sf, EXAMPLE_ROOT), EXAMPLE_ROOT)


def q_form4_counts(spark, sf):
    return ingest.form4_counts(ingest.form4_index(render.render_index_texts(fx.index_rows(spark, sf))))


def q_parse_filings(spark, sf):
    trades, _rejects = parse.parse_filings(render.render_filings(fx.raw_trades(spark, sf)))
    return trades


def q_parse_rejects(spark, sf):
    """Trades of filings of which every third ends before its root element is closed, with the
    share of them that were listed as rejects."""
    filings = render.render_filings(fx.raw_trades(spark, sf))
    cut = F.substring(F.md5("file_name"), 1, 1).isin("0", "3", "6", "9", "c", "f")
    broken = F.when(cut, F.replace("content", F.lit("</ownershipDocument>"), F.lit("<footnotes><footnote>"))).otherwise(F.col("content"))
    docs = parse.parse_documents(filings.withColumn("content", broken))
    trades = parse.trades_from_documents(docs.withColumn("file_name", F.concat(F.when(F.col("doc._corrupt_record") != "", "rejected_").otherwise("read_"), "file_name")), keep_file_name=True)
    return trades.select(F.substring_index("file_name", "_", 1).alias("state"), "accession_number", "ticker", "transaction_date", "transaction_code", "shares", "price_per_share")


def q_score_role(spark, sf):
    return fx.trades(spark, sf).select(
        "accession_number", "ticker", "owner_title", "transaction_code", scores.score_role("owner_title").alias("score_role")
    )


def q_score_value(spark, sf):
    value, buy = F.col("total_value"), F.col("transaction_code") == S.BUY.code
    high = F.when(buy, scores.score_value_high(S.BUY.high_threshold, value)).otherwise(scores.score_value_high(S.SELL.high_threshold, value))
    return fx.trades(spark, sf).select(
        "accession_number", "ticker", "transaction_code", "total_value",
        scores.score_value_mid(value).alias("score_value_mid"), high.alias("score_value_high"),
    )


def q_cluster_count(spark, sf):
    return _scored_both_sides(spark, sf).select("ticker", "filing_date", "transaction_code", "cluster_count")


def q_score_cluster(spark, sf):
    return _scored_both_sides(spark, sf).select("ticker", "filing_date", "transaction_code", "cluster_count", "score_cluster")


def q_conviction_score(spark, sf):
    return _scored_both_sides(spark, sf).select(
        "accession_number", "ticker", "filing_date", "transaction_code", "total_value", "conviction_score"
    )


def q_signal_counts(spark, sf):
    return S.signal_counts(fx.trades(spark, sf))


def q_elite_count(spark, sf):
    return E.elite_count(_enriched(spark, sf))


def q_elite_buys(spark, sf):
    return serving.elite_buys(_enriched(spark, sf))


def q_sell_rollup(spark, sf):
    return serving.sell_rollup(_sells(spark, sf))


def q_trade_explorer(spark, sf):
    return serving.trade_explorer(fx.trades(spark, sf))


def q_explorer_metrics(spark, sf):
    return serving.explorer_metrics(serving.explorer_trades(fx.trades(spark, sf)))


def q_net_volume(spark, sf):
    return serving.net_volume(serving.explorer_trades(fx.trades(spark, sf)))


def q_price_history(spark, sf):
    return serving.price_history(fx.prices(spark, sf), None, EXAMPLE_AS_OF)


def q_price_overlay(spark, sf):
    explorer = serving.explorer_trades(fx.trades(spark, sf), ticker=EXAMPLE_TICKER)
    return serving.price_overlay(fx.prices(spark, sf), explorer, EXAMPLE_TICKER, EXAMPLE_AS_OF)


def q_projected_price(spark, sf):
    return serving.projected_price(fx.smoke_prices(spark, sf))


def q_fundamentals_as_of(spark, sf):
    return E.fundamentals_as_of(fx.fundamentals_history(spark, sf), fx.trades(spark, sf))


def q_trade_display(spark, sf):
    """Display texts of every trade: prices, totals and half cents at rounding ties."""
    rows = fx.trades(spark, sf).select("accession_number", "ticker", "transaction_date", "transaction_code", "price_per_share", "total_value")
    rows = rows.withColumn("ratio", display.fixed1(F.floor(F.col("total_value") / 1000) / 4))
    return serving.explorer_display(rows.withColumn("price_per_share", F.floor(F.col("price_per_share") * 8) / 8))


def _lake(spark) -> str:
    """A fresh lake root in the shared folder."""
    return scratch_path(spark, f"lake-{uuid.uuid4().hex[:12]}")


def _days(df) -> list:
    return [r[0] for r in df.select("filing_date").distinct().collect()]  # one row per calendar day


def _monthly(df, day: str = "filing_date"):
    """Rows filed on the first of their month: fewer, larger lake partitions, all rows kept."""
    return df.withColumn(day, F.trunc(day, "MM"))


def _stored_trades(spark, sf) -> str:
    root, trades = _lake(spark), _monthly(fx.trades(spark, sf))
    lake.write_day(trades, root, K.TABLE_TRADES, _days(trades), sort_asc="ticker")
    return root


def q_scan_filings(spark, sf):
    root = _lake(spark)
    render.land_texts(fx.day_files(spark, sf).withColumn("folder", render.day_folder()), root)
    found = read_filings(spark, root)
    return found.select("file_name", "filing_date", F.length("content").cast("long").alias("n_chars"), F.md5("content").alias("md5"))


def q_scan_trades(spark, sf):
    return lake.trades_view(spark, _stored_trades(spark, sf))


def q_scan_signals(spark, sf):
    root, sells = _lake(spark), _monthly(_sells(spark, sf))
    lake.write_day(sells, root, K.TABLE_SELL_SIGNALS, _days(_monthly(fx.trades(spark, sf))), sort_desc="conviction_score")
    return lake.signals_view(spark, root, "sell")


def q_write_partitioned(spark, sf):
    """All days written once, then the days of odd months again with sales only: their purchases go,
    and every other day stays."""
    root, trades = _stored_trades(spark, sf), _monthly(fx.trades(spark, sf))
    odd = trades.filter(F.month("filing_date") % 2 == 1)
    lake.write_day(odd.filter(F.col("transaction_code") == "S"), root, K.TABLE_TRADES, _days(odd))
    stored = lake.trades_view(spark, root)
    return stored.groupBy("filing_date", "transaction_code").agg(F.count(F.lit(1)).alias("trades"), F.sum("shares").alias("shares"))


def q_table_preview(spark, sf):
    """The preview rows of the stored trades, with the table's row count beside them."""
    stored = lake.trades_view(spark, _stored_trades(spark, sf))
    order = ["cik", "accession_number", "filing_date", "ticker", "transaction_date", "transaction_code", "shares", "price_per_share"]
    return lake.preview_rows(stored, 10, order).withColumn("row_count", F.lit(stored.count()).cast("long"))


def q_run_dates(spark, sf):
    """The daily batch over all days (here: months): filings of about 200 line items each land as gzipped
    files, the index in parts; the stored tables are counted per day."""
    # the joined line items are counted, listed by day and landed: joined once, read three times, then freed
    columns = ["accession_number", "filing_date", *render.TRANSACTION_COLUMNS]
    root = _lake(spark)
    with staging(spark) as stage:
        raw = stage(_monthly(fx.raw_trades(spark, sf)).select(*columns), "line-items")
        days = _days(raw)
        render.land_rendered(fx.day_filings(raw), _monthly(fx.index_rows(spark, sf), "date_filed"), root, gzipped=True)
    report = run_dates(spark, root, days)
    if report["failed_days"]:
        raise RuntimeError(f"failed days: {report['failed_days']}")
    stored = lake.trades_view(spark, root).select("filing_date", F.lit("trades").alias("stored"))
    for side in ("buy", "sell"):
        stored = stored.unionByName(lake.signals_view(spark, root, side).select("filing_date", F.lit(f"{side}_signals").alias("stored")))
    stored = stored.unionByName(lake.index_view(spark, root).select("filing_date", F.lit("form4_filings").alias("stored")))
    return stored.groupBy("filing_date", "stored").agg(F.count(F.lit(1)).alias("n"))


def _holding(query: Query) -> Query:
    """The query with its cached lookups held as long as its result is referenced."""

    def build(spark: SparkSession, sf: str) -> DataFrame:
        return with_own_lookups(lambda: query(spark, sf))

    build.__name__ = build.__qualname__ = getattr(query, "__name__", "query")
    build.__doc__ = query.__doc__
    return build


_QUERIES: dict[str, Query] = {
    "index_calendar": q_index_calendar,
    "master_index": q_master_index,
    "form4_index": q_form4_index,
    "download_plan": q_download_plan,
    "form4_counts": q_form4_counts,
    "parse_filings": q_parse_filings,
    "fundamentals": _fundamentals,
    "price_history": q_price_history,
    "score_role": q_score_role,
    "score_value": q_score_value,
    "cluster_count": q_cluster_count,
    "score_cluster": q_score_cluster,
    "conviction_score": q_conviction_score,
    "buy_signals": _buys,
    "sell_signals": _sells,
    "signal_counts": q_signal_counts,
    "enriched_signals": _enriched,
    "elite_count": q_elite_count,
    "elite_buys": q_elite_buys,
    "sell_rollup": q_sell_rollup,
    "trade_explorer": q_trade_explorer,
    "explorer_metrics": q_explorer_metrics,
    "net_volume": q_net_volume,
    "price_overlay": q_price_overlay,
    "projected_price": q_projected_price,
    "parse_rejects": q_parse_rejects,
    "fundamentals_as_of": q_fundamentals_as_of,
    "trade_display": q_trade_display,
    "scan_filings": q_scan_filings,
    "scan_trades": q_scan_trades,
    "scan_signals": q_scan_signals,
    "write_partitioned": q_write_partitioned,
    "table_preview": q_table_preview,
    "run_dates": q_run_dates,
}

QUERIES: dict[str, Query] = {name: _holding(q) for name, q in _QUERIES.items()}
