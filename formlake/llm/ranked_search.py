"""Ranked lexical search, reversed: the queries are indexed and the documents stream past them.

Terms are the maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` of a whole text, only A-Z
lower-cased. An item's terms go into an inverted index (term -> items). Then:

1. One pass over the documents counts their terms. Of each document with a term it keeps its
   length and the counts of the terms some item holds, as numbers of the index; partial aggregates
   of that table give N, L and the document frequencies.
2. The index with the terms' weights is broadcast, and each document's counts stream through it.
   Every task holds one heap of at most ``k`` hits per item; a hit that does not beat the worst of a
   full heap is turned away before it reaches it.
3. The heaps of all tasks are merged by item in two steps: ``GROUPS`` groups of tasks apart, then the rest.

A weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's ``m`` is ``100 - 90 + (90 * n * N) div L``,
and a term adds ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``; all but the logarithm is in 64-bit integers.

Memory: items beyond ``INDEX_CHARS`` characters or ``INDEX_ITEMS`` items are dealt by a hash of their id
into blocks of about that size, one pass each; an item is never cut. A document is held as its
distinct terms only while it is counted.

Defined results: a null text, or one without a term, counts in neither N nor L and is never found;
every row of the documents is a document, so repeated rows fill a place each; an item is an item id
and its terms are those of all rows with that id (repeated rows add nothing, a null id is an
item of its own); an item without terms, or whose terms no document holds, has no rows; equal
scores go by ascending document id, a null id last; extra columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.common import staged
from formlake.llm.textkit import small_batches

K = 10
GROUPS = 128
INDEX_CHARS = 4_000_000
INDEX_ITEMS = 20_000
# UTF-8 bytes: digits, letters and all bytes beyond ASCII belong to a term, the rest of ASCII is a space
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_NO_ID = (1 << 63) - 1  # orders a null id after all others


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """Inverted index of a block of items: the items of term t are ``items[first[t]:first[t + 1]]``."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]):
        self.ids = [item for item, _ in items]
        self.vocabulary = sorted(set().union(*(own for _, own in items)))
        number = {t: k for k, t in enumerate(self.vocabulary)}
        term = np.array([number[t] for _, own in items for t in own], dtype=np.int64)
        owner = np.repeat(np.arange(len(items), dtype=np.int32), [len(own) for _, own in items])
        self.items = owner[np.argsort(term, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.vocabulary)))]).astype(np.int64)


class Heaps:
    """The best ``k`` (score, document) of every item; more score first, then the smaller id."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        # what a new hit has to beat: the worst of a full heap, else any score above 0
        self.score = np.zeros(n_items, dtype=np.int64)
        self.doc = np.full(n_items, np.iinfo(np.int64).min)

    def offer(self, items: np.ndarray, scores: np.ndarray, doc: int) -> None:
        """One document's distinct ``items`` with their scores."""
        worst = self.score[items]
        better = (scores > worst) | ((scores == worst) & (doc < self.doc[items]))
        for item, score in zip(items[better].tolist(), scores[better].tolist()):
            heap = self.heaps[item]
            if len(heap) < self.k:
                heappush(heap, (score, -doc))
            else:
                heapreplace(heap, (score, -doc))
            if len(heap) == self.k:
                self.score[item], self.doc[item] = heap[0][0], -heap[0][1]


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(owner)), pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"]
            )

    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "item_id long, term binary").distinct()


def blocks(items: DataFrame, chars: int = INDEX_CHARS, most: int = INDEX_ITEMS) -> Iterator[Postings]:
    """The inverted indexes of all items, about ``chars`` characters and ``most`` items at a time."""
    found = staged(item_terms(items), "search-items")
    sizes = found.groupBy("item_id").agg(F.sum(F.length("term")).alias("c")).agg(F.count(F.lit(1)), F.sum("c")).first()
    n = max(1, -(-sizes[0] // most), -(-(sizes[1] or 0) // chars))
    place = F.pmod(F.coalesce(F.xxhash64("item_id"), F.lit(0)), F.lit(n))
    for block in range(n):
        own: dict[int | None, list[bytes]] = {}
        for item, term in found.filter(place == block).collect():
            own.setdefault(item, []).append(bytes(term))
        if own:
            yield Postings(list(own.items()))


def counted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, ids, tfs) of every document with a term: its length and its counts in the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(known.value, pa.binary())
        for batch in small_batches(batches, "text"):
            length, sizes, words, tfs = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                own = Counter(found)
                length.append(len(found))
                sizes.append(len(own))
                words.extend(own)
                tfs.extend(own.values())
            number = pc.index_in(pa.array(words, pa.binary()), value_set=listed)
            held = number.is_valid().to_numpy(zero_copy_only=False)
            inside = np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
            offsets = pa.array(inside, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(length, pa.int64()),
                    pa.ListArray.from_arrays(offsets, number.drop_null()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.array(tfs, np.int32)[held], pa.int32())),
                ],
                names=["doc_id", "n", "ids", "tfs"],
            )
            yield out.filter(pc.greater(out.column("n"), 0))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>")


def streamed(counts: DataFrame, index: Postings, weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(item, score, doc_id, part): what the heaps of every task hold after its documents."""
    shared = counts.sparkSession.sparkContext.broadcast((index.first, index.items, weights, len(index.ids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, posted, w, n_items = shared.value
        heaps, scores = Heaps(n_items, k), np.zeros(n_items, dtype=np.int64)
        for batch in batches:
            ids, tfs = batch.column("ids"), batch.column("tfs")
            at = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            ids, tfs = ids.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            m = 10 + (90 * batch.column("n").to_numpy() * n_docs) // total
            value = w[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, np.diff(at))))
            docs = batch.column("doc_id").fill_null(_NO_ID).to_pylist()
            for d, doc in enumerate(docs):
                own, add = ids[at[d] : at[d + 1]], value[at[d] : at[d + 1]]
                size = first[own + 1] - first[own]
                ends = np.cumsum(size)
                if not len(own):
                    continue
                hits = posted[np.arange(ends[-1]) + np.repeat(first[own] - ends + size, size)]
                np.add.at(scores, hits, np.repeat(add, size))
                # an item's first hit stands for it; its score is cleared again for the next document
                reached = hits[scores[hits] >= np.maximum(heaps.score[hits], 1)]
                if len(reached):
                    reached = np.unique(reached)
                    heaps.offer(reached, scores[reached], doc)
                scores[hits] = 0
        rows = [(item, score, -doc) for item, heap in enumerate(heaps.heaps) for score, doc in heap]
        if rows:
            item, score, doc = (np.array(c, dtype=np.int64) for c in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(doc, mask=doc == _NO_ID)], names=["item", "score", "doc_id"])

    found = counts.mapInArrow(run, "item long, score long, doc_id long")
    return found.withColumn("part", F.spark_partition_id())


def merged(heaps: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every item over all heaps: (item, rank, doc_id, score)."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    step = Window.partitionBy("item", "group").orderBy(*best)
    near = heaps.withColumn("group", F.col("part") % GROUPS).withColumn("rank", F.row_number().over(step)).filter(F.col("rank") <= k)
    last = Window.partitionBy("item").orderBy(*best)
    return near.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, chars: int = INDEX_CHARS, most: int = INDEX_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of every item (item_id, text)."""
    spark = docs.sparkSession
    out = None
    for index in blocks(items, chars, most):
        counts = staged(counted(docs, index.vocabulary), "search-counts")
        n_docs, total = (int(x or 0) for x in counts.agg(F.count(F.lit(1)), F.sum("n")).first())
        held = counts.select(F.explode("ids").alias("t")).groupBy("t").count().collect()
        weights = np.zeros(len(index.vocabulary), dtype=np.int64)
        for t, df in held:
            weights[t] = weight(n_docs, df)
        heaps = streamed(counts, index, weights, n_docs, max(1, total), k)
        named = spark.createDataFrame(list(enumerate(index.ids)), "item long, item_id long")
        found = merged(heaps, k).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
