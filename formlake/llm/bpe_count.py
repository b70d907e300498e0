"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary and its scores come from a sentencepiece BPE model; the merging is done here.
A text starts as one symbol per character (a character without a piece of its own as one
symbol per UTF-8 byte). The adjacent pair of the lowest rank, leftmost first, is popped from a
heap and merged in a doubly linked list until no pair is left. The count is the number of
initial symbols minus the merges; no identifiers are made.

Texts are cut where no piece can reach across: before a word's leading space mark, and at
line ends if no piece holds one (both are checked against the vocabulary; otherwise the
whole text is one segment). Counts of short segments are remembered, at most
``CACHE`` of them per task.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows repeat their
result; null ids and extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.textkit import column_bytes, small_batches

CACHE = 600_000
CACHED_LENGTH = 48
SPACE = "▁"  # the mark sentencepiece puts for a space
_PLACE = (1 << 40) - 1


class MergeCounter:
    """Token counts of whole texts for one sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        order = {s: k for k, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in pieces.items() if len(p) > 1}
        self.known = {p for p in pieces if len(p) == 1}
        self.by_word = not any(a != SPACE and b == SPACE for p in pieces for a, b in zip(p, p[1:]))
        self.by_line = not any("\n" in p for p in pieces)
        probe = "  A  ﬁ b\tc\nd　é <s> "
        self.plain = model.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.counts: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Symbols left of one segment when no pair can be merged."""
        rank, n = self.rank, len(text)
        get = rank.get
        left = n
        if not self.known.issuperset(text):
            left += sum(len(c.encode()) - 1 for c in text if c not in self.known)
        if n < 2:
            return left
        symbols, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
        live = [get(text[i : i + 2], -1) for i in range(n - 1)]
        live.append(-1)
        heap = [(r << 40) | i for i, r in enumerate(live) if r >= 0]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & _PLACE
            if live[i] != entry >> 40:
                continue  # the pair is gone or has changed
            j = after[i]
            merged = symbols[i] = symbols[i] + symbols[j]
            k = after[i] = after[j]
            live[j] = -1
            left -= 1
            r = -1
            if k < n:
                before[k] = i
                r = get(merged + symbols[k], -1)
                if r >= 0:
                    heappush(heap, (r << 40) | i)
            live[i] = r
            p = before[i]
            if p >= 0:
                live[p] = r = get(symbols[p] + merged, -1)
                if r >= 0:
                    heappush(heap, (r << 40) | p)
        return left

    def _cached(self, segment: str) -> int:
        if len(segment) > CACHED_LENGTH:
            return self.segment(segment)
        if len(self.counts) >= CACHE:
            self.counts.clear()
        count = self.counts[segment] = self.segment(segment)
        return count

    def _words(self, text: str) -> int:
        """Tokens of a line: its segments are the runs of space marks with the word after them."""
        get, total, marks = self.counts.get, 0, ""
        parts = text.split(SPACE)
        first = parts[0]
        if first:
            total += get(first) or self._cached(first)
        for part in parts[1:]:
            marks += SPACE
            if part:
                word = marks + part
                total += get(word) or self._cached(word)
                marks = ""
        return total + (self._cached(marks) if marks else 0)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE) if self.plain else self.model.normalize(text)
        if not self.by_word:
            return self.segment(text)
        if not self.by_line:
            return self._words(text)
        lines = text.split("\n")
        return sum(map(self._words, lines)) + len(lines) - 1  # a line end is one byte symbol


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = MergeCounter(model_file)
        for batch in small_batches(batches, "text"):
            _, offsets = column_bytes(batch.column("text"))
            tokens = np.array([counter.count(t) for t in batch.column("text").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
