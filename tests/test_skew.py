"""The skew-safe joins give the same rows on every path, and salt only hot keys."""

from pyspark.sql import functions as F

from formlake.operators.joins import attach_group_count, lookup_join
from formlake.operators.signals import BUY, score_trades
from formlake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def hot_table(spark):
    # key 0 holds a third of all rows
    base = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    return base


def test_group_count_paths_agree_under_a_hot_key(spark):
    df = hot_table(spark)
    broadcast = attach_group_count(df, ["k"], "n")
    salted = attach_group_count(df, ["k"], "n", max_broadcast_rows=10, task_rows=1_000)
    plain = attach_group_count(df, ["k"], "n", max_broadcast_rows=0, task_rows=10**9)
    assert rows(broadcast) == rows(salted) == rows(plain)
    assert salted.filter(F.col("k") == 0).select(F.min("n")).first()[0] == 10_000
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def test_salted_join_spreads_the_hot_key(spark):
    df = hot_table(spark)
    salted = attach_group_count(df, ["k"], "n", max_broadcast_rows=10, task_rows=1_000)
    # the hot key's rows are split over ceil(10000 / 1000) = 10 salts
    spread = (
        df.join(salted.select("k", "v", "n"), ["k", "v"])
        .filter(F.col("k") == 0)
        .select(F.pmod(F.xxhash64("k", "v"), F.lit(10)).alias("s"))
        .distinct()
        .count()
    )
    assert spread == 10


def test_lookup_join_inner_and_left(spark):
    big = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, x string")
    look = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, y double")
    for kw in ({}, {"max_broadcast_rows": 0, "task_rows": 1}):
        assert rows(lookup_join(big, look, ["k"], "left", **kw)) == [
            (1, "a", 10.0), (1, "b", 10.0), (2, "c", 20.0), (3, "d", None)
        ]
        assert len(rows(lookup_join(big, look, ["k"], "inner", **kw))) == 3


def test_cluster_scores_identical_when_forced_to_salt(spark):
    trades = fx.trades(spark, SF_SMALL)
    spark.conf.set("formlake.broadcast.maxRows", "0")
    spark.conf.set("formlake.skew.rowsPerTask", "1")
    try:
        salted = rows(score_trades(trades, BUY))
    finally:
        spark.conf.unset("formlake.broadcast.maxRows")
        spark.conf.unset("formlake.skew.rowsPerTask")
    assert salted == rows(score_trades(trades, BUY))


def test_hot_null_key_is_salted_and_never_matches(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    look = spark.createDataFrame([(None, 1.0), ("1", 2.0)], "k string, y double")
    for kw in ({}, {"max_broadcast_rows": 0, "task_rows": 100}):
        out = lookup_join(df, look, ["k"], "left", **kw)
        assert out.count() == 9_000
        assert out.filter(F.col("k").isNull() & F.col("y").isNotNull()).count() == 0
        assert out.filter(F.col("k") == "1").first()["y"] == 2.0
    salted = lookup_join(df, look, ["k"], "left", max_broadcast_rows=1, task_rows=100)
    nulls = salted.filter(F.col("k").isNull())
    # 3,000 null-key rows are spread over ceil(3000 / 100) = 30 salts
    assert "__salt" in salted._jdf.queryExecution().executedPlan().toString()
    assert nulls.count() == 3_000


def test_equal_rows_of_a_hot_key_use_all_salts(spark):
    df = spark.range(3_000).select(F.lit(7).alias("k"), F.lit("same").alias("x"))
    df = df.unionByName(spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("other").alias("x")))
    look = spark.createDataFrame([(k, float(k)) for k in range(50)], "k int, y double")
    out = lookup_join(df, look, ["k"], "left", max_broadcast_rows=0, task_rows=100)
    assert rows(out) == rows(lookup_join(df, look, ["k"], "left"))
    # the salted side of the join as planned: 3,001 rows of the hot key over ceil(3001 / 100) salts
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "__copy" in plan and "__salt" in plan
    salts = F.pmod(F.xxhash64("k", "x", F.col("copy")), F.lit(31))
    spread = spark.range(1, 3_001).select(F.lit(7).alias("k"), F.lit("same").alias("x"), F.col("id").alias("copy")).select(salts.alias("s"))
    assert spread.distinct().count() == 31


def test_large_lookups_are_not_broadcast_whatever_their_row_count(spark):
    from formlake.operators.joins import small_enough

    wide = spark.range(100).select(F.col("id").cast("int").alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 200).alias("y")).persist()
    assert small_enough(wide, 1_000)
    spark.conf.set("formlake.broadcast.maxBytes", "10000")
    try:
        assert not small_enough(wide, 1_000)
    finally:
        spark.conf.unset("formlake.broadcast.maxBytes")
        wide.unpersist()


def test_anti_join_beyond_the_bound_lets_sure_rows_pass(spark):
    from formlake.operators.joins import anti_join, key_bitmaps, with_may_match

    left = spark.range(4000).select((F.col("id") % 1500).alias("a"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("b"), F.col("id").alias("n"))
    left = left.unionByName(spark.createDataFrame([(None, "p1", -1), (3, None, -2)], "a long, b string, n long"))
    right = left.filter("n % 3 = 0 or n < 0").select("a", "b")
    expected = sorted(map(tuple, left.join(right, ["a", "b"], "left_anti").collect()), key=repr)
    out = anti_join(left, right, ["a", "b"], max_broadcast_rows=10)
    assert out.columns == left.columns and sorted(map(tuple, out.collect()), key=repr) == expected
    assert sorted(map(tuple, anti_join(left, right.limit(0), ["a", "b"], max_broadcast_rows=-1).collect()), key=repr) == sorted(map(tuple, left.collect()), key=repr)
    bits = 2 * 32_768
    marked = with_may_match(left, key_bitmaps(right, ["a", "b"], bits), ["a", "b"], bits)
    # no key is missed, and few others are kept
    assert marked.filter("n % 3 = 0 and not __may").count() == 0
    assert marked.filter("n % 3 != 0 and __may").count() < 200
