"""Removal of repeated strings by a logarithmic family of suffix arrays.

A byte goes if a ``LENGTH``-byte string covering it also starts anywhere else in the corpus.

1. Routing. Every window of ``LENGTH`` bytes has one *anchor*: the leftmost of its ``GRAM``-byte
   grams with the smallest hash. Equal windows have equal anchors at equal places, and the
   windows of one anchor are consecutive: a *piece*. About 1.3 % of the positions are anchors, so the
   corpus is shuffled as one short row per piece, never as text. An anchor seen once has no
   repeated window. Pieces seen twice or more with equal bytes are repeated as a whole.
2. What is left are the distinct pieces of repeated anchors, mostly the borders of
   repeated passages. They are cut into cells of ``CELL`` windows; the bytes common to all windows of
   a cell (its core) choose the shard, so equal windows meet and the pieces of one hot anchor
   spread by their cores. Cells with equal bytes are counted once before they are gathered.
3. In its shard each batch of cells gets a suffix array (window starts sorted by their next
   ``LENGTH`` bytes) and is merge-scanned against the levels already there; equal starts in a
   batch or between a batch and a level are long matches. The batch then becomes a level, and
   levels of equal size class merge, so there are at most log2(batches) + 1 of them. A core
   with more than ``CORE_WINDOWS`` window starts in distinct cells (a passage followed by different text
   in many places) goes to no shard: its windows are routed one by one, by a hash of their own
   ``LENGTH`` bytes, and counted by partial aggregates. So shards hold about ``SHARD_WINDOWS`` window
   starts, whatever the size of the corpus.
4. Matched windows become byte spans per document, and the spans are cut out.

Defined results: a null text is empty; a text under ``LENGTH`` bytes keeps all bytes; a row repeated
as a whole (id and text) counts as another place, so all copies lose their strings: such rows are
settled by a count, and one copy stands for them in the search; nulls and repeats of ``doc_id`` are
otherwise told apart by a hash of id and text; other columns pass through. A long text is read in
overlapping tiles of ``TILE_BYTES``. A periodic text has an
anchor at nearly every position: it costs more rows, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import delete_staged, shuffle_tasks, staged
from formlake.llm.textkit import Rolling, chunks, column_bytes, mix, signed, small_batches
from formlake.operators.joins import lookup_join, with_own_lookups

LENGTH = 200
GRAM = 50
CELL = 38
BATCHES = 4
SHARD_WINDOWS = 200_000
CORE_WINDOWS = 25_000
TILE_BYTES = 256 << 10
_U = np.uint64


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every full run of ``width`` values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(document, anchor, piece, start, windows, place of the anchor) of all pieces of the documents.

    Starts and places count from the document's beginning.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 6
    rolling = Rolling(data)
    at = np.arange(len(data) - gram + 1)
    grams = rolling(at, at + gram)
    # order by 32 hash bits, then by place: the leftmost smallest gram, alike in every buffer
    ranked = ((grams >> _U(32)) << _U(32)) | at.astype(np.uint64)
    place = (_sliding_min(ranked, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(place))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    valid = starts + length <= offsets[doc + 1]
    starts, place, doc = starts[valid], place[valid], doc[valid]
    if not len(starts):
        return (np.zeros(0, np.int64),) * 6
    fresh = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    s, p, d = starts[first], place[first], doc[first]
    piece = mix(rolling(s, s + count - 1 + length) ^ mix((count * 4096 + (p - s)).astype(np.uint64)))
    return d, signed(grams[p]), signed(piece), s - offsets[d], count, p - offsets[d]


def tiles(offsets: np.ndarray, length: int, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first document, first byte, own offsets) of neighbouring stretches of about ``limit`` bytes: whole
    documents, or parts of a longer one that overlap by ``length - 1`` bytes, so every window lies in one."""
    for i, j in chunks(offsets, limit):
        size = int(offsets[j] - offsets[i])
        if j > i + 1 or size <= limit:
            yield i, int(offsets[i]), offsets[i : j + 1] - offsets[i]
        else:
            for at in range(0, max(1, size - length + 1), limit):
                yield i, int(offsets[i]) + at, np.array([0, min(limit + length - 1, size - at)], dtype=np.int64)


def _pieces_of(docs: DataFrame, length: int, gram: int, tile: int) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("anchor", pa.int64()), ("piece", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("p", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            keys = batch.column("key").to_numpy()
            data, offsets = column_bytes(batch.column("text"))
            for i, at, own in tiles(offsets, length, tile):
                d, anchor, piece, s, n, p = pieces(data[at : at + own[-1]], own, length, gram)
                if len(d):
                    ahead = at - int(offsets[i])  # where a tile inside a document begins; 0 for whole documents
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i + d]), pa.array(anchor), pa.array(piece), *(pa.array(x.astype(np.int32)) for x in (s + ahead, n, p + ahead))], schema=schema)

    return docs.select("key", "text").mapInArrow(run, "key long, anchor long, piece long, s int, n int, p int")


class SuffixFamily:
    """Suffix arrays of geometrically growing size over fixed-length starts."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, ids: np.ndarray, repeated: np.ndarray) -> None:
        """Index a batch; sets ``repeated[id]`` of every start met before or twice in the batch."""
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        same = keys[1:] == keys[:-1]
        repeated[ids[1:][same]] = True
        repeated[ids[:-1][same]] = True
        alone = np.concatenate([[True], ~same])
        keys, ids = keys[alone], ids[alone]
        for level_keys, level_ids in self.levels:
            at = np.minimum(np.searchsorted(level_keys, keys), len(level_keys) - 1)
            hit = level_keys[at] == keys
            repeated[ids[hit]] = True
            repeated[level_ids[at[hit]]] = True
        self.levels.append((keys, ids))
        while len(self.levels) > 1 and len(self.levels[-1][0]).bit_length() >= len(self.levels[-2][0]).bit_length():
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, who = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(both, kind="stable")
            both, who = both[order], who[order]
            first = np.concatenate([[True], both[1:] != both[:-1]])
            self.levels.append((both[first], who[first]))


def _starts(content: bytes, count: int, length: int) -> np.ndarray:
    """The ``count`` windows of a cell as sortable fixed-length strings."""
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(content, np.uint8), length)[:count]
    return np.ascontiguousarray(view).view(f"S{length}").ravel()


def _cells(prepared: DataFrame, length: int, cell: int) -> DataFrame:
    """One row per cell of a border piece: (core, content, key, s, n, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("core", pa.int64()), ("content", pa.int64()), ("key", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("bytes", pa.binary())])
        for batch in small_batches(batches, "packed", 1 << 18):
            rows = [[], [], [], [], [], []]
            for key, packed, marks in zip(batch.column("key").to_pylist(), batch.column("packed").to_pylist(), batch.column("marks").to_pylist()):
                text = _unpack(packed)
                for m in marks:
                    if not m["border"]:
                        continue
                    s, n, p = m["s"], m["n"], m["p"]
                    # windows by how far their start lies before the anchor
                    for k in range((p - s - n + 1) // cell, (p - s) // cell + 1):
                        lo, hi = max(s, p - k * cell - cell + 1), min(s + n - 1, p - k * cell)
                        content = text[lo : hi + length]
                        core = text[p - k * cell : p - k * cell - cell + 1 + length]
                        digest = hashlib.blake2b(content, digest_size=8, salt=bytes([k, hi - p + k * cell + cell, hi - lo])).digest()
                        for x, v in zip(rows, (hashlib.blake2b(core, digest_size=8).digest(), digest, key, lo, hi - lo + 1, content)):
                            x.append(v)
            if rows[2]:
                ints = [pa.array(np.frombuffer(b"".join(x), np.int64)) for x in rows[:2]]
                yield pa.RecordBatch.from_arrays([*ints, pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.int32()), pa.array(rows[5], pa.binary())], schema=schema)

    return prepared.mapInArrow(run, "core long, content long, key long, s int, n int, bytes binary")


def _matched(cells: DataFrame, shards: int, length: int, batches: int) -> DataFrame:
    """(key, s, n) runs of repeated windows among distinct cells, one suffix family per shard."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def matched(parts: list[pd.DataFrame]) -> pd.DataFrame:
            rows = pd.concat(parts, ignore_index=True)
            count = rows["n"].to_numpy()
            base = np.concatenate([[0], np.cumsum(count)])
            repeated = np.zeros(base[-1], dtype=bool)
            family = SuffixFamily()
            for _, part in rows.groupby("batch", sort=True):
                at = part.index.to_numpy()
                keys = np.concatenate([_starts(rows["bytes"][i], count[i], length) for i in at])
                ids = np.concatenate([np.arange(base[i], base[i + 1]) for i in at])
                family.add(keys, ids, repeated)
            cell_of = np.repeat(np.arange(len(rows)), count)
            hit = np.flatnonzero(repeated)
            if not len(hit):
                return pd.DataFrame({"key": [], "s": [], "n": []}).astype({"key": "int64", "s": "int32", "n": "int32"})
            fresh = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (cell_of[hit[1:]] != cell_of[hit[:-1]])])
            first = np.flatnonzero(fresh)
            who = cell_of[hit[first]]
            start = rows["s"].to_numpy()[who] + hit[first] - base[who]
            size = np.diff(np.append(first, len(hit)))
            return pd.DataFrame({"key": rows["key"].to_numpy()[who], "s": start.astype("int32"), "n": size.astype("int32")})

        held, now = [], None
        for frame in frames:
            for shard, rows in frame.groupby("shard", sort=False):
                if held and shard != now:
                    yield matched(held)
                    held = []
                now = shard
                held.append(rows)
        if held:
            yield matched(held)

    placed = cells.withColumn("shard", F.pmod("core", F.lit(shards))).withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)))
    tasks = max(1, min(shards, shuffle_tasks(cells.sparkSession)))
    return placed.repartition(tasks, "shard").sortWithinPartitions("shard").mapInPandas(run, "key long, s int, n int")


def _counted(cells: DataFrame, length: int, label: str) -> DataFrame:
    """(key, s, n) of repeated windows among distinct cells, each window counted by its own hash."""
    at = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at")
    windows = cells.select("core", "key", "s", "bytes", at).select(
        "core", F.xxhash64(F.col("bytes").substr(F.col("at") + 1, F.lit(length))).alias("window"), "key", (F.col("s") + F.col("at")).alias("s")
    )
    windows = staged(windows, f"{label}-windows")
    # a table of its own, as the anchors are: a window in many cells can be split
    again = staged(windows.groupBy("core", "window").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("core", "window"), f"{label}-again")
    return windows.join(again, ["core", "window"], "left_semi").select("key", "s", F.lit(1).alias("n"))


_CODEC = "zstd"


def _pack(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + pa.compress(text, codec=_CODEC, asbytes=True) if text else b""


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec=_CODEC, asbytes=True) if packed else b""


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed before they cross the network."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            data, offsets = column_bytes(batch.column("text"))
            raw = data.tobytes()
            packed = pa.array([_pack(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("rest"), packed], names=["key", "rest", "packed"])

    kind = rows.schema["rest"].dataType.simpleString()
    return rows.select("key", "rest", "text").mapInArrow(run, f"key long, rest {kind}, packed binary")


def _cut(rows: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Cut the spans out: (rest, n_bytes, n_removed, n_spans, kept_sha256[, text])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "packed", 1 << 20):
            out = [[], [], [], [], []]
            for packed, marks, more in zip(batch.column("packed").to_pylist(), batch.column("marks").to_pylist(), batch.column("more").to_pylist()):
                text = _unpack(packed)
                spans = [(m["s"], m["s"] + m["n"] - 1 + length) for m in marks or () if not m["border"]]
                spans = sorted(spans + [(m["s"], m["s"] + m["n"] - 1 + length) for m in more or ()])
                kept, at, runs = [], 0, 0
                for a, b in spans:
                    if a > at or not runs:
                        kept.append(text[at:a])
                        runs += 1
                        at = b
                    elif b > at:
                        at = b
                kept = b"".join([*kept, text[at:]])
                for x, v in zip(out, (len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)):
                    x.append(v)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
            names = ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array([x.decode("utf-8", "ignore") for x in out[4]], pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *arrays], names=names)

    kind = rows.schema["rest"].dataType.simpleString()
    return rows.select("rest", "packed", "marks", "more").mapInArrow(
        run, f"rest {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text
    )


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, cell: int = CELL, batches: int = BATCHES, with_text: bool = False, label: str = "suffix") -> DataFrame:
    """Cut repeated strings out of ``docs`` (doc_id, text, any more columns).

    Returns ``rest`` (a struct of all columns but text), n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 and, if asked for, ``text`` (the remaining bytes; a span may begin
    or end inside a character, whose stray bytes then go too).
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), rest.alias("rest"), F.col("text").cast("string").alias("text"))
    twice = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key", F.lit(True).alias("copied")), f"{label}-copied")
    if twice.isEmpty():
        return _cut_distinct(rows, length, gram, cell, batches, with_text, label)

    def with_copies() -> DataFrame:
        marked = lookup_join(rows, twice, ["key"])
        copies = marked.filter("copied")
        # one copy of each, without a row of its own, stands for the text in the search
        one = copies.groupBy("key").agg(F.first("text", ignorenulls=True).alias("text"))
        searched = marked.filter("copied is null").select("key", "rest", "text").unionByName(
            one.select("key", F.lit(None).cast(rows.schema["rest"].dataType).alias("rest"), "text")
        )
        cut = _cut_distinct(searched, length, gram, cell, batches, with_text, label)
        return cut.unionByName(_cut_copies(copies, length, with_text))

    return with_own_lookups(with_copies)


def _cut_copies(copies: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Rows that repeat as a whole: all their strings stand elsewhere, so only a text under ``length`` bytes stays."""
    text, n = F.coalesce("text", F.lit("")), F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    gone = n >= length
    kept = F.when(gone, F.lit("")).otherwise(text)
    return copies.select(
        "rest", n.alias("n_bytes"), F.when(gone, n).otherwise(F.lit(0).cast("long")).alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"), *([kept.alias("text")] if with_text else []),
    )


def _cut_distinct(rows: DataFrame, length: int, gram: int, cell: int, batches: int, with_text: bool, label: str) -> DataFrame:
    """``cut_repeats`` of (key, rest, text) with unique keys; rows without a ``rest`` are searched, not returned."""
    found = staged(_pieces_of(rows, length, gram, TILE_BYTES), f"{label}-pieces")

    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("places"), F.min("piece").alias("lo"), F.max("piece").alias("hi"))
    # a table of its own, so that the join reads two plain exchanges and a hot anchor can be split
    anchors = staged(anchors.filter("places > 1").select("anchor", (F.col("lo") == F.col("hi")).alias("alike")), f"{label}-anchors")
    again = staged(found.join(anchors, "anchor"), f"{label}-again")
    delete_staged(found, anchors)
    mixed = again.filter("not alike")
    # distinct pieces of an anchor that has several: their borders are compared below
    distinct = mixed.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "s", "n", "p")).alias("one"))
    distinct = staged(distinct, f"{label}-distinct")
    whole = again.filter("alike").select("key", "s", "n", "p")
    whole = whole.unionByName(mixed.join(distinct.filter("c > 1"), ["anchor", "piece"], "left_semi").select("key", "s", "n", "p"))
    border = distinct.select("one.key", "one.s", "one.n", "one.p")
    marks = whole.withColumn("border", F.lit(False)).unionByName(border.withColumn("border", F.lit(True)))
    marks = marks.groupBy("key").agg(F.collect_list(F.struct("s", "n", "p", "border")).alias("marks"), F.max("border").alias("open"))
    prepared = staged(_packed(rows).join(marks, "key", "left"), f"{label}-prepared")
    delete_staged(again, distinct)

    cells = staged(_cells(prepared.filter("open").select("key", "packed", "marks"), length, cell), f"{label}-cells")
    kinds = cells.groupBy("core", "content").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "s", "n")).alias("one"), F.min("bytes").alias("bytes"))
    kinds = staged(kinds.select("core", "content", "c", "one.key", "one.s", "one.n", "bytes"), f"{label}-kinds")
    hot = staged(kinds.groupBy("core").agg(F.sum("n").alias("windows")).filter(F.col("windows") > CORE_WINDOWS), f"{label}-hot")
    apart = hot.agg(F.sum("windows")).first()[0] or 0
    windows = (kinds.agg(F.sum("n")).first()[0] or 0) - apart
    own = kinds.select("core", "key", "s", "n", "bytes")
    matched = _matched(own.join(hot, "core", "left_anti") if apart else own, max(1, -(-windows // SHARD_WINDOWS)), length, batches)
    if apart:
        matched = matched.unionByName(_counted(own.join(hot, "core", "left_semi"), length, f"{label}-hot"))
    twice = cells.join(kinds.filter("c > 1").select("core", "content"), ["core", "content"], "left_semi").select("key", "s", "n")
    more = matched.unionByName(twice).groupBy("key").agg(F.collect_list(F.struct("s", "n")).alias("more"))

    done = prepared.filter("open is null or not open").withColumn("more", F.lit(None).cast("array<struct<s:int,n:int>>"))
    opened = prepared.filter("open").join(staged(more, f"{label}-more"), "key", "left")
    delete_staged(cells, kinds, hot)
    return _cut(done.unionByName(opened).filter("rest is not null"), length, with_text)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` (``n_chars`` follows); no row is dropped."""
    out = cut_repeats(docs, with_text=True)
    columns = [F.col("text") if c == "text" else F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(f"rest.`{c}`").alias(c) for c, t in docs.dtypes]
    return out.select(*columns)
