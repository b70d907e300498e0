"""The serving queries: ranked buy list, rolled-up sells, trade explorer and its views.

Limits are the feature here (top-k reports). Every sort appends the remaining output
columns as tie-breaks so a cut-off at k is deterministic; Spark plans
``orderBy(...).limit(k)`` as a distributed top-k (``TakeOrderedAndProject``), and text
formatting runs after the limit, on k rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake import constants as K
from formlake.functions.exact import exact_sum
from formlake.functions.display import dip_text, dollars0, dollars2, fixed1, marker_label, sell_reason


def _top(df: DataFrame, descending: list[str], limit: int) -> DataFrame:
    """First ``limit`` rows by ``descending`` columns (nulls last), then by every other
    column ascending (nulls first) as a tie-break."""
    lead = [F.col(c).desc_nulls_last() for c in descending]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in descending]
    return df.orderBy(*lead, *rest).limit(limit)


def money(sum_expr: Column) -> Column:
    """Money totals are rounded to cents, so a total does not depend on the order in
    which partitions were summed."""
    return F.round(sum_expr, 2)


ELITE_COLUMNS = [
    "filing_date",
    "ticker",
    "owner_name",
    "owner_title",
    "total_value",
    "ahab_score",
    "pe_ratio",
    "dip_from_52w_high",
    "cluster_count",
]


def elite_buys(enriched: DataFrame, min_score: int = K.ELITE_MIN_SCORE, limit: int = K.ELITE_LIMIT) -> DataFrame:
    """Newest, best-scored enriched buys; the dip is shown as text like '31.2%'."""
    rows = enriched.filter(F.col("ahab_score") >= min_score).select(*ELITE_COLUMNS)
    top = _top(rows, ["filing_date", "ahab_score"], limit)
    return top.withColumn("dip_from_52w_high", dip_text("dip_from_52w_high"))


ROLLUP_KEYS = ["filing_date", "ticker", "company_name", "owner_name", "owner_title"]


def sell_rollup_groups(sell_signals: DataFrame) -> DataFrame:
    """All sell groups (day, ticker, company, owner, title) with a positive total.

    A partial aggregate: hot groups are combined map-side before the shuffle.
    """
    grouped = sell_signals.groupBy(*ROLLUP_KEYS).agg(
        F.max("conviction_score").alias("conviction_score"),
        F.max("cluster_count").alias("cluster_size"),
        exact_sum("total_value").alias("total_value_aggregated"),
        exact_sum("shares").alias("total_shares"),
        F.count(F.lit(1)).alias("num_transactions"),
    )
    return grouped.filter(F.col("total_value_aggregated") > 0)


def sell_rollup(sell_signals: DataFrame, limit: int = K.SELL_ROLLUP_LIMIT) -> DataFrame:
    """Top sell groups by day and score, with a reason text.

    Groups are kept and flagged by their exact sums, whatever the order of summing; the shown total (in
    cents) and average come last.
    """
    groups = sell_rollup_groups(sell_signals)
    reason = sell_reason(F.col("owner_title"), F.col("total_value_aggregated"), F.col("cluster_size"))
    total = money(F.col("total_value_aggregated"))
    avg = F.try_divide(total, F.nullif(F.col("total_shares"), F.lit(0.0)))
    shown = groups.withColumn("signal_context", reason).withColumn("total_value_aggregated", total).withColumn("avg_price", avg)
    return _top(shown, ["filing_date", "conviction_score"], limit).select(*[c for c in shown.columns if c != "signal_context"], "signal_context")


EXPLORER_COLUMNS = [
    "filing_date",
    "transaction_date",
    "ticker",
    "owner_name",
    "owner_title",
    "transaction_code",
    "price_per_share",
    "total_value",
]


def explorer_trades(trades: DataFrame, min_value: float = K.EXPLORER_MIN_VALUE, ticker: str | None = None) -> DataFrame:
    """All trades worth at least ``min_value``, optionally for one ticker: what the explorer's
    totals and charts are computed over.

    The ticker input is upper-cased (not trimmed); an empty input means all tickers.
    Both values are bound as literals, never spliced into SQL text.
    """
    rows = trades.filter(F.col("total_value") >= F.lit(min_value))
    if ticker:
        rows = rows.filter(F.col("ticker") == F.upper(F.lit(ticker)))
    return rows.select(*EXPLORER_COLUMNS)


def trade_explorer(
    trades: DataFrame,
    min_value: float = K.EXPLORER_MIN_VALUE,
    ticker: str | None = None,
    limit: int = K.EXPLORER_LIMIT,
) -> DataFrame:
    """The latest ``limit`` of ``explorer_trades``: the table that is shown."""
    return _top(explorer_trades(trades, min_value, ticker), ["transaction_date"], limit)


def explorer_metrics(explorer: DataFrame) -> DataFrame:
    """(visible_trades, avg_trade_size); the average is null when nothing is visible."""
    return explorer.agg(
        F.count(F.lit(1)).alias("visible_trades"),
        F.try_divide(money(exact_sum("total_value")), F.count(F.lit(1)).cast("double")).alias("avg_trade_size"),
    )


def net_volume(explorer: DataFrame) -> DataFrame:
    """Signed daily value per (transaction_date, transaction_code): P adds, others subtract."""
    signed = F.when(F.col("transaction_code") == "P", F.col("total_value")).otherwise(-F.col("total_value"))
    return (
        explorer.filter(F.col("transaction_date").isNotNull() & F.col("transaction_code").isNotNull())
        .groupBy("transaction_date", "transaction_code")
        .agg(money(exact_sum(signed)).alias("plot_value"))
    )


def price_history(prices: DataFrame, ticker: str | None = None, as_of: str | dt.date | None = None) -> DataFrame:
    """Daily closes of the year up to ``as_of`` (all tickers when ``ticker`` is None)."""
    rows = prices.select("ticker", "date", "close")
    if ticker:
        rows = rows.filter(F.col("ticker") == F.upper(F.lit(ticker)))
    if as_of is not None:
        end = F.to_date(F.lit(str(as_of)))
        rows = rows.filter((F.col("date") > F.add_months(end, -12)) & (F.col("date") <= end))
    return rows


def price_overlay(prices: DataFrame, explorer: DataFrame, ticker: str, as_of: str | dt.date) -> DataFrame:
    """One long table for the price chart: the close line plus buy and sell markers.

    Columns ``(series, date, value, label)``; markers sit at the trade price.
    """
    line = price_history(prices, ticker, as_of).select(
        F.lit("price").alias("series"),
        F.col("date"),
        F.col("close").alias("value"),
        F.lit(None).cast("string").alias("label"),
    )
    mine = explorer.filter((F.col("ticker") == F.upper(F.lit(ticker))) & F.col("transaction_code").isin("P", "S"))
    # both marker series from one pass over the explorer's trades
    is_buy = F.col("transaction_code") == "P"
    markers = mine.select(
        F.when(is_buy, F.lit("buy")).otherwise(F.lit("sell")).alias("series"),
        F.col("transaction_date").alias("date"),
        F.col("price_per_share").alias("value"),
        F.when(is_buy, marker_label("buy", F.col("owner_name"), F.col("total_value")))
        .otherwise(marker_label("sell", F.col("owner_name"), F.col("total_value")))
        .alias("label"),
    )
    return line.unionByName(markers)


def projected_price(df: DataFrame) -> DataFrame:
    """``ticker`` and ``price * 1.1`` (the setup smoke check)."""
    return df.select("ticker", (F.col("price") * 1.1).alias("projected_price"))


# --- optional display projections (run on the k rows of a report) ---------------------


def elite_buys_display(elite: DataFrame) -> DataFrame:
    """Totals as '$1,234' and P/E as '12.3'."""
    return elite.withColumn("total_value", dollars0(F.col("total_value"))).withColumn("pe_ratio", fixed1(F.col("pe_ratio")))


SELL_DISPLAY_COLUMNS = [
    "filing_date", "ticker", "owner_name", "owner_title", "total_value_aggregated", "conviction_score", "signal_context",
]


def sell_rollup_display(rollup: DataFrame) -> DataFrame:
    """The seven shown columns, totals as '$1,234'."""
    return rollup.select(*SELL_DISPLAY_COLUMNS).withColumn(
        "total_value_aggregated", dollars0(F.col("total_value_aggregated"))
    )


def explorer_display(explorer: DataFrame) -> DataFrame:
    """Totals as '$1,234', prices as '$12.34'."""
    return explorer.withColumn("total_value", dollars0(F.col("total_value"))).withColumn(
        "price_per_share", dollars2(F.col("price_per_share"))
    )


def explorer_metrics_display(metrics: DataFrame) -> DataFrame:
    """'1,234' visible trades and an average like '$12,345' (null when nothing is visible)."""
    return metrics.select(
        F.format_number(F.col("visible_trades"), 0).alias("visible_trades"),
        dollars0(F.col("avg_trade_size")).alias("avg_trade_size"),
    )
