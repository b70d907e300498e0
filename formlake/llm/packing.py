"""Best-fit packing of tokenised documents, improved by swaps.

Documents become token ids with an end mark; those longer than a sequence are cut into full
pieces, the remainder first. Pieces are dealt to shards of about ``SHARD`` pieces by a hash, and each
shard is packed on its own: best fit in decreasing length, then a local search among the
underfull bins. A *move* takes a piece into a fuller bin, a one-for-one exchange puts a longer
piece for a shorter one into the fuller bin, a two-for-one exchange puts two pieces for a third
one there; each raises the sum of squared fills. All underfull bins are partners: their pieces are
indexed by length and their pairs by the sum of lengths. The search ends when no step is left (or
as few bins remain as the total length needs), and bins that run empty are gone. A shard wastes about one bin, whatever the size of the corpus, and no task
holds more than its shard.

Defined results: a null or empty text is the end mark alone; every row is packed, repeated ids
too; equal lengths are taken in the order of (doc_id, piece); extra columns play no part.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import shuffle_tasks, staged
from formlake.llm.textkit import small_batches

CAPACITY = 1024
SHARD = 30_000
END = 2
SPECIAL = "<|endoftext|>"


def encoder(ranks_file: str, pattern: str):
    """text -> token ids; the special string in a text is its special id, as the tokenizers file says."""
    import base64

    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})

    def encode(text: str) -> list[int]:
        return own.encode(text, allowed_special="all") if SPECIAL in text else own.encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, ranks_file: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_file, pattern)
        for batch in small_batches(batches, "text"):
            rows: tuple[list, ...] = ([], [], [], [], [])
            done: dict[str, list[tuple[int, int, int, int]]] = {}  # copies in a batch are encoded once
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                cut = done.get(text)
                if cut is None:
                    ids = array("I", encode(text))
                    ids.append(end)
                    raw, n = memoryview(ids.tobytes()), len(ids)
                    bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    cut = done[text] = [(k, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                for found in cut:
                    for column, value in zip(rows, (doc_id, *found)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, schema)], schema=schema)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions) of a best-fit packing; ``lengths`` in decreasing order."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin with room r
    for i, length in enumerate(lengths):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= length
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


class PairIndex:
    """Pairs of pieces that share an underfull bin, by the sum of their lengths; emptiest bin first.

    Of pairs of one bin with equal sums one is listed. Entries of a bin that has changed since are
    dropped when they are met.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], fill: list[int], capacity: int):
        self.bins, self.lengths, self.fill, self.capacity = bins, lengths, fill, capacity
        self.heaps: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(capacity + 1)]
        self.version = [0] * len(bins)
        self.sums = 0  # bit s: the heap of sum s may hold something

    def renew(self, k: int, listed: bool) -> None:
        """Forget the pairs of bin ``k`` and, if ``listed``, list those it has now."""
        self.version[k] += 1
        if not listed:
            return
        by_length: dict[int, list[int]] = {}
        for i in self.bins[k]:
            by_length.setdefault(self.lengths[i], []).append(i)
        found: dict[int, tuple[int, int]] = {}
        own = sorted(by_length)
        for at, a in enumerate(own):
            if len(by_length[a]) > 1:
                found.setdefault(2 * a, tuple(by_length[a][:2]))
            for b in own[at + 1 :]:
                found.setdefault(a + b, (by_length[a][0], by_length[b][0]))
        for s, (i, j) in found.items():
            heappush(self.heaps[s], (self.fill[k], k, self.version[k], i, j))
            self.sums |= 1 << s

    def _top(self, s: int):
        heap = self.heaps[s]
        while heap and heap[0][2] != self.version[heap[0][1]]:
            heappop(heap)
        if not heap:
            self.sums &= ~(1 << s)
        return heap[0] if heap else None

    def largest(self, least: int, most: int, target: int):
        """(sum, i, j) of the largest sum in (least, most] of a bin not fuller than the target."""
        within = self.sums & ((1 << (min(most, self.capacity) + 1)) - 1)
        while (s := within.bit_length() - 1) > least:
            within &= ~(1 << s)
            top, aside = self._top(s), None
            if top and top[1] == target:  # the target's own pair: look behind it
                aside = heappop(self.heaps[s])
                top = self._top(s)
            if aside:
                heappush(self.heaps[s], aside)
                self.sums |= 1 << s
            if top and top[0] <= self.fill[target]:
                return s, top[3], top[4]
        return None


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search: moves and exchanges between underfull bins that raise the sum of squared fills."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    under = {k for k, f in enumerate(fill) if f < capacity}
    where = {i: k for k in under for i in bins[k]}
    index = sorted((lengths[i], i) for i in where)  # pieces of underfull bins by length
    pairs = PairIndex(bins, lengths, fill, capacity)
    for k in under:
        pairs.renew(k, True)

    def shift(i: int, source: int, target: int) -> None:
        bins[source].remove(i)
        bins[target].append(i)
        where[i] = target
        fill[source] -= lengths[i]
        fill[target] += lengths[i]

    def changed(k: int) -> None:
        """Bring the indexes up to date; a full or empty bin takes no further part."""
        open_still = 0 < fill[k] < capacity
        pairs.renew(k, open_still)
        if not open_still:
            under.discard(k)
            for i in bins[k]:
                del index[bisect_left(index, (lengths[i], i))]
                del where[i]

    def longest(most: int, least: int, target: int):
        """The longest piece of length in (least, most] in a bin not fuller than the target."""
        at = bisect_left(index, (most + 1, -1))
        while at:
            at -= 1
            length, i = index[at]
            if length <= least:
                return None
            if where[i] != target and fill[where[i]] <= fill[target]:
                return i
        return None

    def step(target: int) -> bool:
        gap = capacity - fill[target]
        i = longest(gap, 0, target)
        if i is not None:  # move
            source = where[i]
            shift(i, source, target)
            changed(source)
            return True
        best = None
        for j in bins[target]:  # one for one
            i = longest(lengths[j] + gap, lengths[j], target)
            if i is not None and (best is None or lengths[i] - lengths[j] > best[0]):
                best = (lengths[i] - lengths[j], (i,), j)
        for j in bins[target]:  # two for one, where that gains more
            if best and best[0] == gap:
                break
            found = pairs.largest(lengths[j] + (best[0] if best else 0), lengths[j] + gap, target)
            if found:
                best = (found[0] - lengths[j], found[1:], j)
        if not best:
            return False
        _, taken, given = best
        source = where[taken[0]]
        for i in taken:
            shift(i, source, target)
        shift(given, target, source)
        changed(source)
        return True

    least, going = -(-sum(lengths) // capacity), True
    while going and sum(map(bool, bins)) > least:
        going = False
        for target in sorted(under, key=lambda k: (-fill[k], k)):  # fullest first
            while target in under and step(target):
                changed(target)
                going = True
    return [b for b in bins if b]


def pack(rows: DataFrame, capacity: int = CAPACITY, label: str = "packing") -> DataFrame:
    """``rows`` (pieces as above) with sequence_id and offset."""
    rows = staged(rows, f"{label}-pieces")
    shards = max(1, -(-rows.count() // SHARD))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def packed(parts: list[pd.DataFrame], shard: int) -> pd.DataFrame:
            own = pd.concat(parts, ignore_index=True).sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
            lengths = own["length"].tolist()
            sequence, offset = [0] * len(own), [0] * len(own)
            for k, members in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
                at = 0
                for i in members:
                    sequence[i], offset[i] = (shard << 32) + k, at
                    at += lengths[i]
            own["sequence_id"], own["offset"] = sequence, offset
            return own.drop(columns="shard")

        held, now = [], None
        for frame in frames:
            for shard, part in frame.groupby("shard", sort=False):
                if held and shard != now:
                    yield packed(held, now)
                    held = []
                now = int(shard)
                held.append(part)
        if held:
            yield packed(held, now)

    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, shard long, sequence_id long, offset long"
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    tasks = max(1, min(shards, 4 * shuffle_tasks(rows.sparkSession)))
    return placed.repartition(tasks, "shard").sortWithinPartitions("shard").mapInPandas(run, fields.replace("shard long, ", ""))


def packed_documents(docs: DataFrame, ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text). The ranks file holds the vocabulary of the
    byte-level BPE tokenizer in its faster form; both give the same ids."""
    import public_tokenizers

    return pack(pieces(docs, ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN))
