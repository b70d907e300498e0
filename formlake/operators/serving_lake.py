"""Serving queries over the lake that read only the newest days they need.

``elite_buys`` and ``sell_rollup`` order by ``filing_date`` descending first, and the lake
is partitioned by ``filing_date``. So their top k lies entirely in the newest days that
together hold at least k qualifying rows (a sell group never spans two days). These
functions read days newest first, in batches that double in size (4, 8, 16, ... days),
count qualifying rows per batch with one small job, and stop once k are found; the
result is then exactly the query over the whole table, computed over those days only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake import constants as K
from formlake.operators import serving
from formlake.schemas import ENRICHED, SIGNALS
from formlake.sources.lake import read_table, stored_days, trades_view

FIRST_BATCH_DAYS = 4


def newest_days_with(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    qualifying: Callable[[DataFrame], DataFrame],
    needed: int,
) -> DataFrame:
    """The table restricted to the newest days holding at least ``needed`` qualifying rows
    (all days if there are fewer; empty without the table). One count job per doubling batch of days."""
    days = stored_days(spark, root, table)
    chosen: list[str] = []
    found, size = 0, FIRST_BATCH_DAYS
    while len(chosen) < len(days) and found < needed:
        batch = days[len(chosen) : len(chosen) + size]
        found += qualifying(read_table(spark, root, table, schema, batch)).count()
        chosen += batch
        size *= 2
    return read_table(spark, root, table, schema, chosen, required=False)


def elite_buys_from_lake(
    spark: SparkSession, root: str, min_score: int = K.ELITE_MIN_SCORE, limit: int = K.ELITE_LIMIT
) -> DataFrame:
    """``serving.elite_buys`` over the stored enriched buys, reading only the newest days needed."""
    enriched = newest_days_with(
        spark, root, K.TABLE_ENRICHED, ENRICHED, lambda df: df.filter(F.col("ahab_score") >= min_score), limit
    )
    return serving.elite_buys(enriched, min_score, limit)


def sell_rollup_from_lake(spark: SparkSession, root: str, limit: int = K.SELL_ROLLUP_LIMIT) -> DataFrame:
    """``serving.sell_rollup`` over the stored sell signals, reading only the newest days needed."""
    sells = newest_days_with(spark, root, K.TABLE_SELL_SIGNALS, SIGNALS, serving.sell_rollup_groups, limit)
    return serving.sell_rollup(sells, limit)


def trade_explorer_from_lake(
    spark: SparkSession,
    root: str,
    min_value: float = K.EXPLORER_MIN_VALUE,
    ticker: str | None = None,
    limit: int = K.EXPLORER_LIMIT,
) -> DataFrame:
    """``serving.trade_explorer`` over the stored trades: one pruned scan and a distributed top k
    (trades are ordered by transaction date, which no partition bounds)."""
    return serving.trade_explorer(trades_view(spark, root), min_value, ticker, limit)
