"""Display projections and reason texts."""

import datetime as dt

from pyspark.sql import functions as F

from formlake.functions.display import dip_text, sell_reason
from formlake.operators import serving


def test_dip_text_half_even(spark):
    df = spark.createDataFrame([(0.3125,), (0.0,), (0.4,)], "d double")
    assert [r[0] for r in df.select(dip_text("d")).collect()] == ["31.2%", "0.0%", "40.0%"]


def test_sell_reason(spark):
    df = spark.createDataFrame(
        [("Chief CFO", 2_000_000.0, 3), (None, 10.0, 1), ("ceo", 1_000_000.0, 2)], "t string, v double, n long"
    )
    got = [r[0] for r in df.select(sell_reason(F.col("t"), F.col("v"), F.col("n"))).collect()]
    assert got == ["👑 C-Suite, 📉 Whale Dump, ⚠️ Cluster (3 sellers)", "", "👑 C-Suite, ⚠️ Cluster (2 sellers)"]


def test_display_projections(spark):
    ex = spark.createDataFrame(
        [(dt.date(2026, 1, 5), dt.date(2026, 1, 2), "A", "o", None, "P", 12.345, 1234567.4)],
        "filing_date date, transaction_date date, ticker string, owner_name string, owner_title string, "
        "transaction_code string, price_per_share double, total_value double",
    )
    row = serving.explorer_display(ex).first()
    assert (row.total_value, row.price_per_share) == ("$1,234,567", "$12.35")
    m = serving.explorer_metrics_display(serving.explorer_metrics(ex)).first()
    assert (m.visible_trades, m.avg_trade_size) == ("1", "$1,234,567")
    empty = serving.explorer_metrics(ex.limit(0)).first()
    assert (empty.visible_trades, empty.avg_trade_size) == (0, None)


def test_fixed_decimals_round_ties_to_even_on_the_exact_value(spark):
    from formlake.functions.display import dollars2, fixed1

    df = spark.createDataFrame([(0.25, 0.125), (0.75, 0.375), (0.35, 1234.005), (None, None)], "a double, b double")
    got = [tuple(r) for r in df.select(fixed1(F.col("a")), dollars2(F.col("b"))).collect()]
    assert got == [("%.1f" % a, "$%.2f" % b) for a, b in [(0.25, 0.125), (0.75, 0.375), (0.35, 1234.005)]] + [(None, None)]


def test_sell_groups_are_kept_and_flagged_by_exact_sums(spark):
    from formlake.schemas import SIGNALS

    def sell(owner, value):
        day = dt.date(2026, 1, 5)
        return ("1", "a", day, "T", "C", owner, None, False, False, False, day, "S", 1.0, value, value, "D", 0, 2, 3, 1, 0, 5)

    df = spark.createDataFrame([sell("cent", 0.003), sell("whale", 1_000_000.004), sell("none", 0.0)], SIGNALS)
    got = {r.owner_name: (r.total_value_aggregated, r.signal_context) for r in serving.sell_rollup(df).collect()}
    assert got == {"cent": (0.0, ""), "whale": (1_000_000.0, "📉 Whale Dump")}
