"""Sums that do not depend on row order, and the merge as-of against a scan."""

import datetime as dt
import functools
import operator
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from formlake import constants as K
from formlake.functions.exact import exact_sum
from formlake.operators import serving
from formlake.operators.enrich import fundamentals_as_of
from formlake.schemas import FUNDAMENTALS_RAW, SIGNALS


def sums(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.repartition(parts, F.rand(parts)).agg(exact_sum("x").alias("s")).first()["s"]


def test_sum_is_exact_and_order_free(spark):
    rng = random.Random(3)
    values = [rng.choice([1e15, -1e15, 0.1, 0.25, 3e-5, 1e17, -1e17, 123456.789]) * rng.choice([1, 1, 3]) for _ in range(400)]
    found = set()
    for parts in (1, 2, 5, 13):
        rng.shuffle(values)
        found.add(sums(spark, values, parts))
    small = sum((Decimal(repr(v)).quantize(Decimal("1e-10")) for v in values if abs(v) < 1e17), Decimal(0))
    assert found == {float(small) + float(sum(Decimal(v) for v in values if abs(v) >= 1e17))}


@pytest.mark.parametrize("values,expected", [([], None), ([None], None), ([1.5, None], 1.5), ([float("inf"), 1.0], float("inf")), ([1e300, 1.0], 1e300), ([5e-324], 0.0)])
def test_special_sums(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(exact_sum("x").alias("s")).first()["s"] == expected


def test_nan_and_opposite_infinities(spark):
    for values in ([float("nan"), 1.0], [float("inf"), float("-inf")]):
        s = sums(spark, values, 1)
        assert s != s


def signal(day, value, shares=1.0):
    return ("1", "acc", day, "ACME", "Acme", "Roe", "Clerk", False, False, False, day, "S", shares, value, value, "D", 0, 2, 3, 3, 2, 7)


def test_a_total_at_the_whale_threshold_is_flagged_alike_in_any_order(spark):
    day = dt.date(2026, 1, 5)
    # ten parts of exactly the threshold: as doubles their sum is above or below it by order
    parts = [0.1] * 7 + [0.3] + [K.WHALE_DUMP_ABOVE - 2.0, 1.0]
    assert sum(map(Decimal, map(str, parts))) == K.WHALE_DUMP_ABOVE
    orders = [parts, parts[::-1], sorted(parts, reverse=True)]
    assert len({functools.reduce(operator.add, o) for o in orders}) > 1
    out = set()
    for order in orders:
        for tasks in (1, 3, 10):
            rows = spark.createDataFrame([signal(day, v) for v in order], SIGNALS).repartition(tasks)
            out.add(tuple(map(tuple, serving.sell_rollup(rows).collect())))
    (only,) = out
    assert len(only) == 1 and K.REASON_WHALE not in str(only)


def test_a_total_of_zero_is_left_out_in_any_order(spark):
    day = dt.date(2026, 1, 5)
    parts = [0.1, 0.2, -0.3, 1e16, -1e16]
    for order in (parts, parts[::-1]):
        assert serving.sell_rollup_groups(spark.createDataFrame([signal(day, v) for v in order], SIGNALS)).count() == 0


def as_of_rows(spark, snapshots, days, as_of="date"):
    schema = FUNDAMENTALS_RAW.simpleString()[7:-1].replace(":", " ") + f", as_of {as_of}"
    raw = spark.createDataFrame([(t, 10.0, 100.0, pe, 1.0, 1.0, 0.1, at) for t, pe, at in snapshots], schema)
    wanted = spark.createDataFrame(days, "ticker string, filing_date date")
    return sorted((r.ticker, r.filing_date, r.pe_ratio) for r in fundamentals_as_of(raw, wanted).collect())


def scan(snapshots, days):
    out = []
    for t, d in {x for x in days if x[0] is not None and x[1] is not None}:
        before = [(at, pe) for s, pe, at in snapshots if s == t and at is not None and at <= d]
        if before:
            out.append((t, d, max(before)[1]))
    return sorted(out)


def test_as_of_equals_a_scan(spark):
    rng = random.Random(9)
    start = dt.date(2015, 1, 1)
    day = lambda: start + dt.timedelta(rng.randrange(4000))
    snapshots = [(rng.choice("ABCD"), float(rng.randrange(1, 900)), day()) for _ in range(60)]
    snapshots += [("E", 5.0, start), ("A", 7.0, None), (None, 8.0, start), *snapshots[:5]]
    days = [(rng.choice(["A", "B", "C", "D", "E", "F", None]), day()) for _ in range(400)] + [("E", start), ("E", dt.date(2014, 12, 31)), ("A", None)]
    assert as_of_rows(spark, snapshots, days) == scan(snapshots, days)


def test_as_of_work_is_linear_in_rows(spark):
    start = dt.date(2014, 1, 1)
    dates = [start + dt.timedelta(k) for k in range(3650)]  # ten years of daily snapshots and days
    snapshots = [("HOT", float(k + 1), d) for k, d in enumerate(dates)]
    out = as_of_rows(spark, snapshots, [("HOT", d) for d in dates])
    assert out == [("HOT", d, float(k + 1)) for k, d in enumerate(dates)]
    schema = FUNDAMENTALS_RAW.simpleString()[7:-1].replace(":", " ") + ", as_of date"
    raw = spark.createDataFrame([(t, 10.0, 100.0, pe, 1.0, 1.0, 0.1, at) for t, pe, at in snapshots[:50]], schema)
    plan = fundamentals_as_of(raw, spark.createDataFrame([("HOT", start)], "ticker string, filing_date date"))._jdf.queryExecution().optimizedPlan().toString()
    assert "as_of" not in "".join(line for line in plan.splitlines() if "Join" in line) and "<=" not in plan
