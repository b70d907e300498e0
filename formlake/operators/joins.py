"""Joins that stay correct and balanced when one key holds a large share of rows.

Two rules drive every join in the library:

* a side is broadcast only after an exact count of the persisted side proves it holds
  at most ``formlake.broadcast.maxRows`` rows and ``formlake.broadcast.maxBytes`` bytes;
* otherwise the join shuffles, and keys of the large side holding more than
  ``formlake.skew.rowsPerTask`` rows are salted: their rows are spread over several
  salt values and the single matching lookup row is replicated once per salt. The set
  of such hot keys holds at most ``total_rows / rowsPerTask`` entries, and is itself
  checked before it is broadcast (a longer list is joined by shuffle). Equal rows are told
  apart by their count: they are combined map-side to (row, copies) and numbered again
  before the salt is taken, so the salt is a function of values alone and a recomputed
  task gives the same one.

Lookups are pre-aggregated (one row per key) before any shuffle, so a hot key never
sends more than one lookup row per salt across the network.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from formlake.session import (
    BROADCAST_MAX_BYTES_DEFAULT,
    BROADCAST_MAX_BYTES_KEY,
    BROADCAST_MAX_ROWS_DEFAULT,
    BROADCAST_MAX_ROWS_KEY,
    ROWS_PER_TASK_DEFAULT,
    ROWS_PER_TASK_KEY,
    conf_int,
    staged,
)

_SALT, _SALTS, _N, _COPY = "__salt", "__salts", "__n", "__copy"

class LookupScope:
    """The lookups cached for one run (so a size check and its join share one computation)."""

    def __init__(self) -> None:
        self._held: list[DataFrame] = []

    def hold(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self._held[-1]

    def release(self) -> None:
        while self._held:
            self._held.pop().unpersist(blocking=False)


_SCOPE: ContextVar[LookupScope | None] = ContextVar("lookup_scope", default=None)


@contextmanager
def lookup_scope():
    """Lookups cached by the joins inside belong to this run and are released at its end, also
    when it fails; those of other runs stay."""
    scope = LookupScope()
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        scope.release()


def with_own_lookups(build: Callable[[], DataFrame]) -> DataFrame:
    """The DataFrame of ``build``, whose lookups stay cached as long as it is referenced."""
    scope = LookupScope()
    token = _SCOPE.set(scope)
    try:
        out = build()
    finally:
        _SCOPE.reset(token)
    weakref.finalize(out, scope.release).atexit = False
    return out


def _persist(df: DataFrame) -> DataFrame:
    """Cached for the current scope; a caller without one clears Spark's cache itself."""
    scope = _SCOPE.get()
    if scope is not None:
        return scope.hold(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cached_bytes(df: DataFrame) -> int:
    """Bytes the filled cache of a persisted DataFrame takes."""
    return int(df.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether a persisted lookup may be broadcast: an exact row count and its cached bytes."""
    if bounded_count(df, max_rows) is None:
        return False
    return cached_bytes(df) <= conf_int(df.sparkSession, BROADCAST_MAX_BYTES_KEY, BROADCAST_MAX_BYTES_DEFAULT)


def bounded_count(df: DataFrame, limit: int) -> int | None:
    """Row count of ``df`` if it is at most ``limit``, else None.

    ``df`` is a persisted lookup, so an exact ``count()`` costs what the join would pay
    anyway: it fills the cache, and only one partial count per partition is shuffled.
    (``limit(n + 1).count()`` would instead send up to n + 1 rows of every partition
    to a single task.)
    """
    n = df.count()
    return n if n <= limit else None


def broadcast_limit(df: DataFrame, override: int | None = None) -> int:
    return override if override is not None else conf_int(df.sparkSession, BROADCAST_MAX_ROWS_KEY, BROADCAST_MAX_ROWS_DEFAULT)


def rows_per_task(df: DataFrame, override: int | None = None) -> int:
    return override if override is not None else conf_int(df.sparkSession, ROWS_PER_TASK_KEY, ROWS_PER_TASK_DEFAULT)


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    key_counts: DataFrame | None = None,
    max_broadcast_rows: int | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Attach the columns of ``lookup`` (at most one row per key) to the rows of ``big``.

    ``how`` is ``left`` or ``inner``. Output columns: ``big``'s, then ``lookup``'s non-key
    columns. ``key_counts`` (keys + ``__n`` = rows of ``big`` per key) may be passed when
    already known; it is only computed on the shuffle path.
    """
    keys = list(keys)
    extra = [c for c in lookup.columns if c not in keys]
    out_cols = big.columns + extra
    max_rows = broadcast_limit(big, max_broadcast_rows)

    lookup = _persist(lookup)
    if small_enough(lookup, max_rows):
        return big.join(F.broadcast(lookup), keys, how).select(*out_cols)

    per_task = rows_per_task(big, task_rows)
    if key_counts is None:
        key_counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    hot = key_counts.filter(F.col(_N) > per_task).select(*keys, F.ceil(F.col(_N) / F.lit(per_task)).cast("long").alias(_SALTS))
    hot = _persist(hot)
    if hot.isEmpty():
        return big.join(lookup, keys, how).select(*out_cols)

    listed = F.broadcast(hot) if small_enough(hot, max_rows) else hot
    marked = _with_salts(big, listed, keys)
    usual = marked.filter(F.col(_SALTS).isNull()).select(*big.columns, F.lit(0).cast("long").alias(_SALT))
    copies = marked.filter(F.col(_SALTS).isNotNull()).groupBy(*big.columns, _SALTS).agg(F.count(F.lit(1)).alias(_N))
    each = copies.withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_N))))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns], F.col(_COPY)), F.col(_SALTS))
    big_salted = usual.unionByName(each.select(*big.columns, salt.alias(_SALT)))
    lookup_salted = _with_salts(lookup, listed, keys).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(_SALTS), F.lit(1)).cast("long") - 1))
    )
    return big_salted.join(lookup_salted.drop(_SALTS), keys + [_SALT], how).select(*out_cols)


def _with_salts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` plus the salt count of its key (null when the key is not hot).

    Null-safe key equality: a null key is a group like any other here, so a hot null
    group is spread as well (its rows still match nothing in the final equi-join).
    """
    renamed = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], _SALTS)
    cond = [df[k].eqNullSafe(F.col(f"__hot_{k}")) for k in keys]
    return df.join(renamed, cond, "left").drop(*[f"__hot_{k}" for k in keys])


def costly(df: DataFrame) -> DataFrame:
    """``df``, marked as one that should not be computed twice (it parses documents, say)."""
    df.formlake_costly = True
    return df


def written_if_costly(df: DataFrame) -> DataFrame:
    """``df`` or, if it is marked ``costly``, the table it is written to in the shared folder. Other inputs
    are cheaper to read twice, pruned to the columns each reading needs."""
    return staged(df, "once") if getattr(df, "formlake_costly", False) is True else df


def attach_group_count(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    max_broadcast_rows: int | None = None,
    task_rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``name`` = number of rows of ``df`` sharing the row's key (null keys get null).

    The count is a partial (map-side) aggregate, so a hot key ships one partial count
    per task instead of its rows; the counts are then joined back with ``lookup_join``.
    ``counts`` (keys and ``name``) may be passed when they are kept somewhere; else ``df`` is
    evaluated a second time for them, with the key columns only (see ``written_if_costly``).
    """
    keys = list(keys)
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    counts = counts.select(*keys, name)
    return lookup_join(
        df,
        counts,
        keys,
        how="left",
        key_counts=counts.withColumnRenamed(name, _N),
        max_broadcast_rows=max_broadcast_rows,
        task_rows=task_rows,
    )


# a bitmap_construct_agg bitmap: 4096 bytes
_BITMAP_BITS = 32_768
_BITS_PER_KEY = 16


def key_bitmaps(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """(bucket, bitmap): the bits that the hashed keys of ``keys`` set in a table of ``bits`` bits."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    rows = keys.select(F.floor(at / _BITMAP_BITS).cast("long").alias("__bucket"), (at % _BITMAP_BITS).alias("__bit"))
    return rows.groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bitmap"))


def with_may_match(df: DataFrame, bitmaps: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """``df`` plus ``__may``: false only for keys that are surely not among those of ``bitmaps``."""
    at = F.pmod(F.xxhash64(*columns), F.lit(bits))
    marked = df.withColumn("__at", at).withColumn("__bucket", F.floor(F.col("__at") / _BITMAP_BITS).cast("long"))
    met = marked.join(F.broadcast(bitmaps), "__bucket", "left")
    inside = F.col("__at") % _BITMAP_BITS
    byte = F.conv(F.hex(F.substring("__bitmap", (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (inside % 8).cast("int")) == 1, F.lit(False))
    return met.withColumn("__may", hit).drop("__at", "__bucket", "__bitmap")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str], max_broadcast_rows: int | None = None) -> DataFrame:
    """Rows of ``left`` with no match in ``right``.

    ``right`` is broadcast only when bounded. Beyond the bound a Bloom filter with one hash, made of
    its keys and no larger than ``formlake.broadcast.maxBytes``, lets the rows of ``left`` pass that surely
    match nothing; only the others are shuffled and joined. ``left`` is then evaluated twice.
    """
    keys = list(keys)
    right = _persist(right.select(*keys))
    max_rows = broadcast_limit(left, max_broadcast_rows)
    if small_enough(right, max_rows):
        return left.join(F.broadcast(right), keys, "left_anti")
    most = conf_int(left.sparkSession, BROADCAST_MAX_BYTES_KEY, BROADCAST_MAX_BYTES_DEFAULT) // 2 * 8
    bits = max(1, min(most, _BITS_PER_KEY * right.count()) // _BITMAP_BITS) * _BITMAP_BITS
    bitmaps = _persist(key_bitmaps(right, keys, bits))
    marked = with_may_match(left, bitmaps, keys, bits)
    sure = marked.filter(~F.col("__may")).drop("__may").select(*left.columns)
    rest = marked.filter("__may").drop("__may").select(*left.columns)
    return sure.unionByName(rest.join(right, keys, "left_anti").select(*left.columns))
