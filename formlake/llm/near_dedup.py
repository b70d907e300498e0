"""MinHash near-dedup with bottom-k sketches of one hash function.

1. ``sketch``: each document's distinct word shingles are hashed once; the sketch is the
   ``SKETCH`` smallest hashes (the whole set up to ``WHOLE`` shingles). Documents with equal
   sets form one class, so a group of copies, however large, goes on as one row.
2. Inverted lists of retained values generate overlaps. Two sets with Jaccard >= 0.8 share
   at least ``SHARED`` of the ``SKETCH`` smallest values of their union (the chance of fewer is
   about 1e-6 at exactly 0.8, less above), so they share one of the rarest
   ``len - SHARED + 1`` values of either sketch: only those values are listed, rarest first by
   list length. Values of one class only never need a list. Sets up to ``SKETCH`` shingles
   are held whole, and the bound is exact.
3. Lists with the same members are followed once. Short lists give their pairs, which the
   union-sketch estimate filters; a long list (``LONG_LIST``) links its members to its smallest,
   unfiltered. The components of these links are *blocks of work*: every pair at or above
   the threshold lies within one.
4. In each block exact Jaccard over full sets verifies: members are compared with the
   sketch estimate first, then exactly, skipping pairs already connected; only a spanning
   forest of verified links leaves the task. A component over ``BLOCK`` members is cut into
   blocks by set size, and each pair of blocks within the size bound is one group, so no
   task ever holds more than ``2 * BLOCK`` documents.

Nothing is dropped or capped: long lists and large components only change how pairs meet.

Defined results: a null or blank text has no shingles and links with nothing; fewer words
than a shingle give the whole sequence as one shingle; a null ``doc_id`` belongs to no
component (``component_id`` null) and is kept; rows that share a ``doc_id`` and a group are one
document and stay or go together, but rows of one ``doc_id`` with unlike texts are judged each in its
own group; ties cannot occur, as the smallest id represents a group. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import components, delete_staged, shuffle_tasks, staged
from formlake.llm.textkit import column_bytes, mix, shingle_sets, small_batches
from formlake.operators.joins import anti_join, lookup_join, with_own_lookups

SKETCH = 64  # retained values
WHOLE = 80  # sets up to this size (SKETCH / 0.8) are retained whole
SHARED = 34  # fewest retained values a linked pair has in common
WIDE, WIDE_WHOLE, WIDE_SHARED = 1024, 1280, 750  # the same for the members of large components
LONG_LIST = 48
BLOCK = 512
_U = np.uint64


def sketch(docs: DataFrame, words: int, size: int = SKETCH, whole: int = WHOLE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, h1, h2, retained) of ``docs`` (doc_id, text): set size, 128-bit
    set hash, and the ``size`` smallest hashes in order (all of them up to ``whole``)."""
    schema = "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, retained array<long>"
    arrow = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("retained", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 8 << 20):
            sizes, first, second, kept = [], [], [], []
            for _, s in shingle_sets(*column_bytes(batch.column("text")), words):
                sizes.append(len(s))
                first.append(int(mix(s).sum(dtype=_U)) >> 1)
                second.append(int(mix(s ^ _U(0x6A09E667F3BCC909)).sum(dtype=_U)) >> 1)
                kept.append((s[: size if len(s) > whole else whole] >> _U(1)).astype(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            values = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                schema=arrow,
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def _listed(reps: DataFrame, label: str, whole: int = SKETCH, least: int = SHARED) -> DataFrame:
    """(value, rep): the rarest retained values of each representative that also occur elsewhere."""
    values = reps.select("rep", F.explode("retained").alias("value"))
    common = staged(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), f"{label}-df")
    shared = values.join(common, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
    # retained values that occur nowhere else are the rarest: they use up the first places
    held = F.size("retained")
    prefix = F.when(F.col("n_shingles") <= whole, F.col("n_shingles") - F.ceil(F.col("n_shingles") * 4 / 5) + 1).otherwise(held - least + 1)
    places = (prefix - (held - F.size("shared"))).cast("int")
    rows = reps.join(shared, "rep").withColumn("places", places).filter("places > 0")
    return rows.select("rep", F.explode(F.slice("shared", F.lit(1), F.col("places"))).alias("e")).select(F.col("e.value").alias("value"), "rep")


def _candidates(reps: DataFrame, label: str) -> DataFrame:
    """(a, b) links whose components hold every pair at or above the threshold."""
    listed = staged(_listed(reps, label), f"{label}-listed")
    lists = listed.groupBy("value").agg(
        F.count(F.lit(1)).alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("sig")
    )
    lists = lists.filter("n > 1").groupBy("n", "low", "high", "sig").agg(F.min("value").alias("value"))
    lists = staged(lists.select("value", "n", "low", "high"), f"{label}-lists")
    two = lists.filter("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    more = listed.join(lists.filter("n > 2"), "value")
    members = more.filter(F.col("n") <= LONG_LIST).groupBy("value").agg(F.sort_array(F.collect_list("rep")).alias("r"))
    few = members.select("r", F.posexplode("r").alias("i", "a")).select("a", F.explode(F.expr("slice(r, i + 2, size(r))")).alias("b"))
    long_links = more.filter((F.col("n") > LONG_LIST) & (F.col("rep") != F.col("low"))).select(F.col("low").alias("a"), F.col("rep").alias("b"))
    pairs = two.unionByName(few).distinct()
    side = lambda k: reps.select(F.col("rep").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("retained").alias(f"s{k}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter("5 * least(na, nb) >= 4 * greatest(na, nb)")
    union = F.array_sort(F.array_union("sa", "sb"))
    whole = (F.col("na") <= WHOLE) & (F.col("nb") <= WHOLE)
    common = F.array_intersect("sa", "sb")
    estimate = F.when(whole, 5 * F.size(common) >= 4 * F.size(union)).otherwise(F.size(F.array_intersect(F.slice(union, 1, SKETCH), common)) >= SHARED)
    return pairs.filter(estimate).select("a", "b").unionByName(long_links)


def _again(clusters: DataFrame, texts: DataFrame, words: int, label: str) -> DataFrame:
    """(a, b) links among the members of components over ``BLOCK``, from wide sketches."""
    large = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > BLOCK)
    members = lookup_join(clusters, large.select("component"), ["component"], "inner").select(F.col("id").alias("rep"))
    wide = sketch(texts.join(members, "rep").select(F.col("rep").alias("doc_id"), "text"), words, WIDE, WIDE_WHOLE)
    wide = staged(wide.select(F.col("doc_id").alias("rep"), "n_shingles", "retained"), f"{label}-wide")
    listed = staged(_listed(wide, f"{label}-wide", WIDE_WHOLE, WIDE_SHARED), f"{label}-wide-listed")
    low = listed.groupBy("value").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    links = listed.join(low, "value").filter("rep != low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    kept = lookup_join(clusters, large.select("component", F.lit(True).alias("large")), ["component"]).filter("large is null and id != component")
    return staged(links.unionByName(kept.select(F.col("component").alias("a"), F.col("id").alias("b"))), f"{label}-again")


def _compare(ids: np.ndarray, sets: list[np.ndarray], apart: np.ndarray | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: exact Jaccard >= num/den; ``apart``: only pairs whose values differ."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    where = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    short = [s[: SKETCH if len(s) > WHOLE else WHOLE] for s in sets]
    short_where = np.concatenate([[0], np.cumsum([len(s) for s in short])])
    short_codes = np.concatenate([codes[where[i] : where[i] + len(s)] for i, s in enumerate(short)])
    seen = np.zeros(int(codes.max()) + 1, dtype=np.int32)
    group, links = np.arange(n), []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        rest = rest[(group[rest] != group[i]) & (den * np.minimum(sizes[rest], sizes[i]) >= num * np.maximum(sizes[rest], sizes[i]))]
        if apart is not None:
            rest = rest[apart[rest] != apart[i]]
        if not len(rest):
            continue
        seen[codes[where[i] : where[i + 1]]] = 1
        # estimate: a linked pair shares SHARED retained values, or 4/5 of the smaller whole set
        shared = np.add.reduceat(seen[short_codes], short_where[:-1])[rest] if len(rest) > 8 else None
        if shared is not None:
            held = short_where[rest + 1] - short_where[rest]
            rest = rest[shared >= np.where(sizes[rest] <= SKETCH, np.ceil(sizes[rest] * num / den), np.minimum(held, SHARED))]
        for j in rest:
            both = int(np.count_nonzero(seen[codes[where[j] : where[j + 1]]]))
            if group[j] != group[i] and den * both >= num * (sizes[i] + sizes[j] - both):
                links.append((int(ids[i]), int(ids[j])))
                group[group == group[j]] = group[i]
        seen[codes[where[i] : where[i + 1]]] = 0
    return links


def _verified(work: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(a, b) verified links. ``work``: rows (task, part, rep, text), a task's rows together."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = [], None

        def links() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            texts = pa.array(rows["text"], pa.large_string())
            sets = [s for _, s in shingle_sets(*column_bytes(texts), words)]
            parts = rows["part"].to_numpy()
            apart = parts if parts.max() != parts.min() else None
            return pd.DataFrame(_compare(rows["rep"].to_numpy(), sets, apart, num, den), columns=["a", "b"], dtype="int64")

        for frame in frames:
            for k, rows in frame.groupby("task", sort=False):
                if k != key and held:
                    yield links()
                    held = []
                key = k
                held.append(rows)
        if held:
            yield links()

    tasks = shuffle_tasks(work.sparkSession)
    return work.repartition(tasks, "task").sortWithinPartitions("task", "part", "rep").mapInPandas(run, "a long, b long")


def _blocks(clusters: DataFrame, sizes: DataFrame) -> DataFrame:
    """(task, part, rep): a small cluster is one task; a large one is cut by set size into
    blocks, and each pair of blocks that can hold a link is one task."""
    count = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    placed = clusters.join(count, "component")
    small = placed.filter(F.col("members") <= BLOCK).select(F.concat_ws("/", "component").alias("task"), F.lit(0).alias("part"), F.col("id").alias("rep"))
    big = placed.filter(F.col("members") > BLOCK).join(sizes, F.col("id") == F.col("rep"))
    # blocks by set size: a histogram per cluster (small: one row per distinct size), then hashing within a size
    steps = big.groupBy("component", "n_shingles").agg(F.count(F.lit(1)).alias("here"))
    from pyspark.sql import Window

    below = Window.partitionBy("component").orderBy("n_shingles").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("here").over(below), F.lit(0)))
    big = big.join(steps, ["component", "n_shingles"])
    half = BLOCK // 2
    place = F.col("before") + F.pmod(F.xxhash64("rep"), F.col("here"))
    big = big.withColumn("block", F.floor(place / half).cast("int")).select("component", "block", "rep", "n_shingles")
    span = big.groupBy("component", "block").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    other = span.select(F.col("component").alias("c2"), F.col("block").alias("block2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    meet = span.join(other, (F.col("component") == F.col("c2")) & (F.col("block") <= F.col("block2")) & (5 * F.col("hi") >= 4 * F.col("lo2")))
    meet = meet.select("component", "block", "block2")
    task = F.concat_ws("/", "component", "block", "block2").alias("task")
    left = big.join(meet, ["component", "block"]).select(task, F.lit(0).alias("part"), "rep")
    right = big.withColumnRenamed("block", "block2").join(meet.filter("block != block2"), ["component", "block2"]).select(task, F.lit(1).alias("part"), "rep")
    return small.unionByName(left).unionByName(right)


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, label: str = "near") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked at exact Jaccard >= num/den of their ``words``-word shingle sets
    (not under 0.8, for which the sketch constants are chosen).
    """
    if 5 * num < 4 * den:
        raise ValueError("the sketch constants hold for a similarity of 0.8 or more")
    out = with_own_lookups(lambda: _labelled(docs, words, num, den, label))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def _labelled(docs: DataFrame, words: int, num: int, den: int, label: str) -> DataFrame:
    """``near_duplicates`` with the ``text_hash`` that tells rows of one id apart."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_sets = staged(sketch(own, words), f"{label}-sketch")
    # equal (h1, h2): equal sets, one class; lists and links know its number and one of its rows
    classes = all_sets.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("retained").alias("retained")
    )
    classes = classes.select(F.monotonically_increasing_id().alias("rep"), "h1", "h2", "one.doc_id", "one.text_hash", "n_shingles", "retained")
    classes = staged(classes, f"{label}-classes")
    reps = classes.select("rep", "n_shingles", "retained")
    clusters = components(_candidates(reps, label), f"{label}-work")
    # the text of every class in a block, once, however often its row repeats
    ids = classes.join(clusters.select(F.col("id").alias("rep")), "rep", "left_semi").select("rep", "doc_id", "text_hash")
    texts = own.withColumn("text_hash", F.xxhash64("text")).join(ids, ["doc_id", "text_hash"])
    texts = staged(texts.groupBy("rep").agg(F.first("text").alias("text")), f"{label}-texts")
    if not clusters.groupBy("component").count().filter(F.col("count") > BLOCK).isEmpty():
        clusters = components(_again(clusters, texts, words, label), f"{label}-apart")
    work = staged(_blocks(clusters, reps.select("rep", "n_shingles")), f"{label}-blocks")
    verified = staged(_verified(work.join(texts, "rep"), words, num, den), f"{label}-links")
    delete_staged(texts, work)
    found = components(verified, f"{label}-found").withColumnRenamed("id", "rep")
    # a group's id is the smallest document of its classes
    grouped = staged(classes.join(found, "rep", "left").select("h1", "h2", "doc_id", F.coalesce("component", "rep").alias("grp")), f"{label}-groups")
    lowest = grouped.groupBy("grp").agg(F.min("doc_id").alias("component"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    labels = lookup_join(grouped, lowest, ["grp"]).select("h1", "h2", F.coalesce("component", "doc_id").alias("component"))
    out = all_sets.select("doc_id", "text_hash", "n_shingles", "h1", "h2").join(labels, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates (five-word shingles, 0.8)."""

    def left() -> DataFrame:
        gone = _labelled(docs, 5, 4, 5, "near").filter("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
        rows = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__text", F.xxhash64(F.col("text").cast("string")))
        return anti_join(rows, gone, ["__id", "__text"]).select(*docs.columns)

    return with_own_lookups(left)
