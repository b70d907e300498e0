"""Quality rules: fixed base rules, then robust multivariate outliers.

DataFrame expressions only. Every text gives a vector of transformed statistics (mean word length,
shares of symbols, capitals, repeated words and duplicate lines). For each language and source the
minimum covariance determinant is sought: the ``HALF`` share of rows whose covariance has the least
determinant. Three starts (medians with absolute deviations alone, with the correlations of
squashed values, and with those of directions) take ``FIRST`` concentration steps each; a step
refits mean and covariance to the rows with the smallest Mahalanobis distances. The start of the least
determinant goes on until no group's determinant falls by more than ``FALL``. Means and covariances are sought
in groups of any size; the covariance is scaled so that the median distance is that of a normal sample, and rows whose
distance a normal sample exceeds with probability ``TAIL`` are rejected. Variances have a floor, so a statistic that is
constant in a group doesn't make its covariance singular.

Each step is an aggregate per group (sums of products and quantile sketches, merged from
partial ones) and a join of the group's few numbers to narrow rows. The numbers of up to ``FEW`` groups, counted in the
written table, are broadcast; those of more are joined by group and one of ``SALTS`` salts (the
group's numbers are repeated per salt), so a source holding a third of all rows is spread either way
and the next aggregate ships one partial per task. Groups under ``LEAST`` rows pool with others of their language, then of all
languages; a pool that is still too small rejects nothing.

Defined results: a null text has no words and fails the base rules; null languages and sources
form a group; repeated rows repeat their result; rows at equal distance share their verdict;
an empty table gives no rows. Extra columns pass by unused.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.common import staged

WINDOW = 8
HALF = 0.75
FIRST = 2
FALL = 1e-3
LEAST = 60
SALTS = 32
FEW = 10_000  # groups of under 300 bytes
TAIL = 1e-9
# standard deviations of the transformed statistics are taken to be this much at least
FLOOR = {"x_length": 0.03, "x_symbols": 0.04, "x_capitals": 0.04, "x_repeats": 0.12, "x_lines": 0.12}
_SPACE = r"[\x20\x09-\x0D]+"


def base_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("__text"))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("__words", F.filter(F.split("__text", _SPACE), lambda w: w != "")).withColumn("__lines", lines)
    n = F.size("__words")
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__words", i, F.lit(WINDOW)))))
    rows = rows.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.expr(r"regexp_count(__text, '[#*$%&|<>]')").cast("long").alias("n_symbols"),
        F.expr(r"regexp_count(__text, '\\p{Lu}')").cast("long").alias("n_capitals"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("__h"),
    )
    # windows found twice, by sorting (hash, place) where any hash repeats
    twice = F.size(F.array_distinct("__h")) < F.size("__h")
    rows = rows.withColumn("__s", F.when(twice, F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    pairs = F.zip_with("__s", F.slice("__s", 2, F.size("__s")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.expr("cast(array() as array<int>)")))
    rows = rows.withColumn("__p", F.array_sort(F.array_distinct(F.flatten(pairs))))
    covered = F.aggregate(
        F.zip_with("__p", F.slice("__p", 2, F.size("__p")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__h", "__s", "__p")


def _vector(stats: DataFrame) -> DataFrame:
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    return stats.withColumns(
        {
            "x_length": F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
            "x_symbols": share("n_symbols", "word_chars"),
            "x_capitals": share("n_capitals", "word_chars"),
            "x_repeats": share("n_repeat_words", "n_words"),
            "x_lines": share("n_dup_lines", "n_lines"),
        }
    )


def _distance(dims: list[str]) -> tuple[dict[str, Column], Column]:
    """Cholesky factor columns of the covariance ``c_i_j`` and the squared distance from ``m_i``."""
    factor: dict[str, Column] = {}
    for j in range(len(dims)):
        for i in range(j, len(dims)):
            rest = F.col(f"c_{j}_{i}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            factor[f"l_{i}_{j}"] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}")
    total = F.lit(0.0)
    for i in range(len(dims)):
        total = total + F.col(f"z_{i}") * F.col(f"z_{i}")
    return factor, total


def _per_salt(groups: DataFrame) -> DataFrame:
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``rows`` (with a salt) with the numbers of their group: broadcast if ``few``, which a count of the groups says; else spread by salt."""
    return rows.join(F.broadcast(groups), keys) if few else rows.join(_per_salt(groups), [*keys, "salt"])


def _chi2(tail: float, dims: int) -> float:
    """The squared distance that a normal sample of ``dims`` dimensions exceeds with probability ``tail``."""

    def above(x: float) -> float:
        total, k = (math.erfc(math.sqrt(x / 2)), 1) if dims % 2 else (math.exp(-x / 2), 2)
        while k < dims:
            total += (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
            k += 2
        return total

    low, high = 0.0, 1000.0
    for _ in range(100):
        low, high = (low, (low + high) / 2) if above((low + high) / 2) < tail else ((low + high) / 2, high)
    return low


def _with_distance(rows: DataFrame, estimate: DataFrame, dims: list[str], keys: list[str], few: bool) -> DataFrame:
    """``rows`` with their squared distance d2 under the estimate of their group."""
    factor, total = _distance(dims)
    out = _joined(rows, estimate.select(*keys, *[f"m_{i}" for i in range(len(dims))], *factor), keys, few)
    for i, dim in enumerate(dims):
        z = F.col(dim) - F.col(f"m_{i}")
        for k in range(i):
            z = z - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        out = out.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
    return out.withColumn("d2", total).select(*rows.columns, "d2")


def _factored(estimate: DataFrame, dims: list[str], keys: list[str], low: list[Column]) -> DataFrame:
    """Estimates (means ``m_i``, covariances ``c_i_j``) with floors, Cholesky factors and the logarithm ``det`` of the determinant."""
    n = len(dims)
    estimate = estimate.withColumns({f"c_{i}_{i}": F.greatest(F.col(f"c_{i}_{i}"), low[i]) for i in range(n)})
    factor, _ = _distance(dims)
    for name, value in factor.items():
        estimate = estimate.withColumn(name, value)
    det = sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(n)), F.lit(0.0))
    return estimate.withColumn("det", det).select(*keys, *[f"m_{i}" for i in range(n)], *factor, "det")


def _concentrated(rows: DataFrame, estimate: DataFrame, dims: list[str], keys: list[str], few: bool, label: str) -> DataFrame:
    """Means and covariances of the ``HALF`` share of each group's rows nearest to its estimate."""
    far = _with_distance(rows, estimate, dims, keys, few)
    near = staged(far.groupBy(*keys).agg(F.percentile_approx("d2", HALF).alias("bar")), f"{label}-near")
    moments = [F.avg(d).alias(f"m_{i}") for i, d in enumerate(dims)]
    moments += [F.covar_pop(a, b).alias(f"c_{i}_{i + j}") for i, a in enumerate(dims) for j, b in enumerate(dims[i:])]
    return _joined(far, near, keys, few).filter("d2 <= bar").groupBy(*keys).agg(*moments)


def _starts(rows: DataFrame, middle: DataFrame, dims: list[str], low: list[Column], few: bool, label: str) -> DataFrame:
    """(grp, start, means, covariances): medians ``middle``, with three shapes of covariance around them."""
    n = len(dims)
    spread = _joined(rows, middle, ["grp"], few).groupBy("grp").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(n)],
        *[(F.percentile_approx(F.abs(F.col(d) - F.col(f"m_{i}")), 0.5) * 1.4826).alias(f"s_{i}") for i, d in enumerate(dims)],
    )
    spread = staged(spread.withColumns({f"s_{i}": F.greatest(F.col(f"s_{i}"), F.sqrt(low[i])) for i in range(n)}), f"{label}-spread")
    scaled = _joined(rows, spread, ["grp"], few).withColumns({f"z_{i}": (F.col(d) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i, d in enumerate(dims)})
    size = F.sqrt(sum((F.col(f"z_{i}") ** 2 for i in range(n)), F.lit(1e-12)))
    scaled = scaled.withColumns({f"u_{i}": F.col(f"z_{i}") / size for i in range(n)})
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]

    def correlation(a: Column, b: Column) -> Column:  # none of a constant statistic
        return F.coalesce(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), F.lit(0.0))

    shapes = [correlation(F.tanh(f"z_{i}"), F.tanh(f"z_{j}")).alias(f"a_{i}_{j}") for i, j in pairs]
    shapes += [correlation(F.col(f"u_{i}"), F.col(f"u_{j}")).alias(f"b_{i}_{j}") for i, j in pairs]
    shapes = spread.join(scaled.groupBy("grp").agg(*shapes), "grp").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))

    def covariance(i: int, j: int) -> Column:
        if i == j:
            return F.col(f"s_{i}") ** 2
        share = F.when(F.col("start") == 1, F.col(f"a_{i}_{j}")).when(F.col("start") == 2, F.col(f"b_{i}_{j}"))
        return F.coalesce(share, F.lit(0.0)) * F.col(f"s_{i}") * F.col(f"s_{j}")

    return shapes.select("grp", "start", *[f"m_{i}" for i in range(n)], *[covariance(i, j).alias(f"c_{i}_{j}") for i in range(n) for j in range(i, n)])


def mcd_estimates(rows: DataFrame, floor: dict[str, float], label: str = "quality") -> DataFrame:
    """(grp, means, Cholesky factors, det) of the least determinant found, of staged ``rows`` (grp, salt, the columns of ``floor``)."""
    dims = list(floor)
    low = [F.lit(floor[d] ** 2) for d in dims]
    rows = rows.select("grp", "salt", *dims)
    keys = ["grp", "start"]
    middle = staged(rows.groupBy("grp").agg(*[F.percentile_approx(d, 0.5).alias(f"m_{i}") for i, d in enumerate(dims)]), f"{label}-middle")
    few = middle.count() <= FEW
    tried = staged(_factored(_starts(rows, middle, dims, low, few, label), dims, keys, low), f"{label}-starts")
    each = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    for step in range(FIRST):
        tried = staged(_factored(_concentrated(each, tried, dims, keys, few, label), dims, keys, low), f"{label}-first{step}")
    numbers = ["det", *[c for c in tried.columns if c not in [*keys, "det"]]]
    best = staged(tried.groupBy("grp").agg(F.min(F.struct(*numbers)).alias("x")).select("grp", "x.*"), f"{label}-best")
    while True:
        after = _factored(_concentrated(rows, best, dims, ["grp"], few, label), dims, ["grp"], low)
        # every group has a nearest share, so every group has a new estimate
        both = after.select("grp", F.struct(*numbers).alias("new")).join(best.select("grp", F.struct(*numbers).alias("old")), "grp")
        falls = F.col("new.det") < F.col("old.det") + math.log1p(-FALL)
        best = staged(both.select("grp", F.least("old", "new").alias("x"), falls.alias("falls")).select("grp", "x.*", "falls"), f"{label}-best")
        if not best.filter("falls").limit(1).count():
            return best.drop("falls")


def mcd_distances(rows: DataFrame, floor: dict[str, float], label: str = "quality") -> DataFrame:
    """``rows`` (with ``grp`` and the columns named in ``floor``) with robust squared distances ``d2``."""
    dims, columns = list(floor), rows.columns
    rows = staged(rows.withColumn("salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS))), f"{label}-rows")
    estimates = mcd_estimates(rows, floor, label)
    few = estimates.count() <= FEW
    far = staged(_with_distance(rows, estimates, dims, ["grp"], few), f"{label}-far")
    scale = staged(far.groupBy("grp").agg((F.percentile_approx("d2", 0.5) / _chi2(0.5, len(dims))).alias("scale")), f"{label}-scale")
    # floors may make the middle distance small; they are not to be scaled away
    far = _joined(far, scale, ["grp"], few)
    return far.withColumn("d2", F.col("d2") / F.greatest("scale", F.lit(1.0))).select(*columns, "d2")


def quality_verdicts(docs: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, base statistics, base_failed, kept, d2) of every row of ``docs`` (doc_id, text, lang, source)."""
    stats = base_statistics(docs, "doc_id", "lang", "source")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = staged(_vector(stats.withColumn("base_failed", failed)), f"{label}-stats")
    lang, source = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    # groups by language and source; small ones pool by language, then over all
    sizes = stats.filter("not base_failed").groupBy(lang.alias("a"), source.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("own", F.col("n") >= LEAST)
    pooled = F.sum(F.when(F.col("own"), 0).otherwise(F.col("n"))).over(Window.partitionBy("a"))
    sizes = sizes.withColumn("grp", F.when(F.col("own"), F.to_json(F.array("a", "b"))).when(pooled >= LEAST, F.to_json(F.array("a"))).otherwise("all"))
    sizes = staged(sizes.select("a", "b", "n", "grp"), f"{label}-groups")
    judged = stats.filter("not base_failed").withColumns({"a": lang, "b": source, "salt": F.pmod(F.xxhash64("doc_id", "x_length"), F.lit(SALTS))})
    few = sizes.count() <= FEW
    judged = _joined(judged, sizes.select("a", "b", "grp"), ["a", "b"], few).drop("a", "b", "salt")
    far = mcd_distances(judged, FLOOR, label)
    enough = staged(sizes.groupBy("grp").agg((F.sum("n") >= LEAST).alias("enough")), f"{label}-enough")
    far = far.withColumn("salt", F.pmod(F.xxhash64("doc_id", "d2"), F.lit(SALTS)))
    far = _joined(far, enough, ["grp"], few).withColumn("kept", ~F.col("enough") | (F.col("d2") <= _chi2(TAIL, len(FLOOR))))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2"]
    gone = stats.filter("base_failed").withColumns({"kept": F.lit(False), "d2": F.lit(None).cast("double")})
    return far.select(*out).unionByName(gone.select(*out))
