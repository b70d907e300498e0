"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are lower-cased with white space as single spaces. An item is searched by its
segments: all of it up to ``SEGMENT`` characters, else overlapping segments of that length, so a
passage quoted in part is found too. A segment of m characters may differ by
``k = RATE * m`` edits.

1. Every position of a text whose ``Q`` characters occur in a segment is a hit on the diagonal
   (text position - segment position). k edits destroy at most k * Q of the m - Q + 1 q-grams, so a
   match has at least ``m - Q + 1 - k * Q`` hits, all within 2k + 1 diagonals.
2. Hits are counted in bands of ``2 * (2k + 1)`` diagonals that overlap by half: each such set of
   diagonals lies in one band. Bands under the bound are dropped.
3. The rest are verified by a semi-global alignment within the band (all candidates of a chunk
   at once): a match has at most k edits.
4. Items under ``MIN_ITEM`` characters take the same way with k = 0, and a match must also begin and end
   at word borders: shorter texts are too common for edits or parts of words to tell. Items under
   ``Q`` characters have no q-gram; they are searched as they are, at word borders.

Tasks hold the q-gram index of the items, some 50 bytes a character. Items beyond ``INDEX_CHARS`` characters in all are taken in
blocks of that size, one pass over the texts each.

Defined results: null or empty texts and items match nothing; an item under ``Q`` characters (a word
or two) is reported by ``find_matches`` but no reason to drop a document, as it says nothing about where
the document comes from; repeated items and rows repeat their matches; null
ids are kept as they are, and items without an id are told apart by their text; of several
matches of an item in a text the one with the fewest edits counts, then the first. Positions
refer to the normalised text. Extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.textkit import small_batches

Q = 8
SEGMENT = 100
RATE = 0.08
MIN_ITEM = 30
INDEX_CHARS = 1_000_000
_CHUNK = 400_000
_U = np.uint64
_BITS = 22


def normalised(text: str | None) -> str:
    return " ".join((text or "").replace("\0", " ").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(code: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters at every position."""
    wide = code.astype(np.uint64) + _U(1)
    h = wide[: len(wide) - q + 1].copy()
    for k in range(1, q):
        h = h * _U(0x9E3779B97F4A7C15) + wide[k : len(wide) - q + 1 + k]
    return h * _U(0xD6E8FEB86659FD93)


_WORD = re.compile(r"\w")


def _at_word_borders(texts) -> re.Pattern:
    """Matches, at every place, one of ``texts`` (of one length) that has no letter or digit beside it."""
    return re.compile(rf"(?<!\w)(?=({'|'.join(map(re.escape, sorted(texts)))})(?!\w))")


class Segments:
    """q-gram index of the segments of the items."""

    def __init__(self, items: list[tuple[int, str | None]], q: int = Q, segment: int = SEGMENT, rate: float = RATE):
        self.q, self.item, self.codes, self.edits = q, [], [], []
        tiny: dict[str, list[int | str]] = {}
        for item_id, raw in items:
            text = normalised(raw)
            if not text:
                continue
            if len(text) < q:
                tiny.setdefault(text, []).append(raw if item_id is None else item_id)
                continue
            last = max(0, len(text) - segment)
            for at in sorted({*range(0, last, segment // 2), last}):
                piece = codes(text[at : at + segment])
                self.item.append(raw if item_id is None else item_id)  # without an id the text tells items apart
                self.codes.append(piece)
                # no more edits than leave a q-gram to count; none in a short item
                self.edits.append(min(int(rate * len(piece)), (len(piece) - q) // q) if len(text) >= MIN_ITEM else 0)
        self.tiny = tiny
        self.tiny_patterns = [_at_word_borders(t for t in tiny if len(t) == n) for n in sorted({len(t) for t in tiny})]
        self.size = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.short = self.size < MIN_ITEM  # a segment of a longer item is never that short
        self.edits = np.array(self.edits, dtype=np.int64)
        self.bound = self.size - q + 1 - self.edits * q
        self.half = 2 * int(self.edits.max(initial=0)) + 1
        hashes = [gram_hashes(c, q) for c in self.codes] or [np.zeros(0, np.uint64)]
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(self.codes)), [len(h) for h in hashes][: len(self.codes)])[order]
        self.place = np.concatenate([np.arange(len(h)) for h in hashes])[order]
        self.keys, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self.keys >> _U(64 - _BITS)] = True

    def candidates(self, code: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, segment, band) whose hits meet the bound; documents start at ``begin`` in ``code``."""
        none = (np.zeros(0, np.int64),) * 3
        if len(code) < self.q or not len(self.keys):
            return none
        h = gram_hashes(code, self.q)
        at = np.flatnonzero(self.seen[h >> _U(64 - _BITS)])
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        real = self.keys[key] == h[at]
        at, key = at[real], key[real]
        if not len(at):
            return none
        n = self.first[key + 1] - self.first[key]
        use = np.repeat(self.first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc = np.searchsorted(begin, at, side="right") - 1
        diagonal = np.repeat(at - begin[doc], n) - self.place[use]
        doc, owner, band = np.repeat(doc, n), self.owner[use], diagonal // self.half
        low, bands = int(band.min()) - 1, int(band.max() - band.min()) + 2
        base = (doc * len(self.codes) + owner) * bands - low
        found, count = np.unique(np.concatenate([base + band, base + band - 1]), return_counts=True)
        owner = found // bands % len(self.codes)
        keep = count >= self.bound[owner]
        found, owner = found[keep], owner[keep]
        return found // bands // len(self.codes), owner, found % bands + low

    def verify(self, code: np.ndarray, begin: np.ndarray, end: np.ndarray, doc, owner, band):
        """(document, segment, start, end, edits) of candidates within their edit budget."""
        out = []
        for m in np.unique(self.size[owner]):
            pick = np.flatnonzero(self.size[owner] == m)
            for part in np.array_split(pick, -(-len(pick) // 2000)):
                d, s = doc[part], owner[part]
                edge = int(self.edits[s].max())
                width = 2 * self.half + 2 * edge
                base = begin[d] + band[part] * self.half - edge  # text position of the first diagonal
                where = base[:, None] + np.arange(m + width)
                inside = (where >= begin[d][:, None]) & (where < end[d][:, None])
                text = np.where(inside, code[np.clip(where, 0, len(code) - 1)], 0)
                pattern = np.stack([self.codes[x] for x in s])
                step = np.arange(width)
                cost = np.zeros((len(part), width), dtype=np.int32)
                for i in range(m):
                    new = cost + (text[:, i : i + width] != pattern[:, i : i + 1])
                    new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
                    cost = np.minimum.accumulate(new - step, axis=1) + step
                best = np.argmin(cost, axis=1)
                edits = cost[np.arange(len(part)), best]
                good = edits <= self.edits[s]
                stop = base[good] + m + best[good] - begin[d[good]]
                out += zip(d[good].tolist(), s[good].tolist(), np.maximum(0, stop - m).tolist(), stop.tolist(), edits[good].tolist())
        return out

    def matches(self, texts: list[str]) -> list[dict[int | str, tuple[int, int, int]]]:
        """Per text: item (its text, if it has no id) -> (edits, start, end) of its best match."""
        out: list[dict[int | str, tuple[int, int, int]]] = [{} for _ in texts]
        joined = codes("\0".join(texts))
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1].astype(np.int64)
        end = begin + np.array([len(t) for t in texts], dtype=np.int64)
        found = self.candidates(joined, begin)

        def keep(d: int, item: int | str, new: tuple[int, int, int]) -> None:
            if item not in out[d] or new < out[d][item]:
                out[d][item] = new

        if len(found[0]):
            short = self.short[found[1]]
            if not short.all():
                for d, s, a, b, e in self.verify(joined, begin, end, *(x[~short] for x in found)):
                    keep(d, self.item[s], (e, a, b))
            for d, s, band in zip(*(x[short].tolist() for x in found)):
                place = self._exactly(texts[d], s, band)
                if place is not None:
                    keep(d, self.item[s], (0, place, place + int(self.size[s])))
        for d, text in enumerate(texts):
            for pattern in self.tiny_patterns:
                for hit in pattern.finditer(text):
                    for item in self.tiny[hit[1]]:
                        keep(d, item, (0, hit.start(1), hit.end(1)))
        return out

    def _exactly(self, text: str, segment: int, band: int) -> int | None:
        """Where the segment first stands between word borders within the diagonals of a band."""
        wanted = self.codes[segment].tobytes().decode("utf-32-le", "surrogatepass")
        low, high = max(0, band * self.half), (band + 2) * self.half
        at = text.find(wanted, low)
        while 0 <= at < high:
            if not (_WORD.match(text, at - 1) if at else None) and not _WORD.match(text, at + len(wanted)):
                return at
            at = text.find(wanted, at + 1)
        return None


def _place(match: tuple[int | str, tuple]) -> tuple:
    return (0, 0, match[0]) if isinstance(match[0], str) else (1, match[0], "")


def _matched(docs: DataFrame, segments: Segments, keep: list[str]) -> DataFrame:
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", _CHUNK):
            found = segments.matches([normalised(t) for t in batch.column("text").to_pylist()])
            rows = [[{"item_id": None if isinstance(k, str) else k, "start": a, "end": b, "edits": e} for k, (e, a, b) in sorted(f.items(), key=_place)] for f in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, kind)], names=[*keep, "matches"])

    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    out = docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, f"{fields}, matches array<struct<item_id: bigint, start: bigint, end: bigint, edits: bigint>>")
    # the new column by place: a kept one may have its name
    return out.toDF(*[f"k{i}" for i in range(len(keep))], "found").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("found").alias("__matches"))


def _blocks(benchmark: DataFrame, least: int = 1) -> Iterator[Segments]:
    """The indexes of all items of at least ``least`` characters, about ``INDEX_CHARS`` at a time."""
    items = benchmark.select("item_id", "text").filter("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // INDEX_CHARS))
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.when(F.col("item_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("item_id")), F.lit(blocks)) == k)
        yield Segments([(r[0], r[1]) for r in part.orderBy("item_id", "text").collect() if len(normalised(r[1])) >= least])


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the best match of every item in every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for segments in _blocks(benchmark):
        found = _matched(own, segments, ["doc_id"]).select("doc_id", F.explode("__matches").alias("m")).select("doc_id", "m.*")
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage."""
    columns = docs.columns
    for segments in _blocks(benchmark, Q):
        docs = _matched(docs, segments, columns).filter(F.size("__matches") == 0).drop("__matches")
    return docs
