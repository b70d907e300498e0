"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentencepiece BPE) the text, to
which it adds the space itself. Of a batch of whole texts:

1. The id lists are flattened, with the index of their document (``list_flatten``,
   ``list_parent_indices``); the ids' byte lengths become end offsets by a cumulative sum that starts
   again with every document.
2. The ends of A and of B meet in an Acero full outer hash join on (document, end). Sorted, its rows
   are the stretches between neighbouring ends; the A and the B token of a stretch are those that end
   next. Two tokens overlap in one stretch or none, so the stretches are the links. Rows with
   both ends close a group.
3. ``Table.group_by`` counts the links per (document, A id, B id), and per id pair of the batch. Spark
   merges the second, finds the highest count of every B id, and joins both back to the first.

Neither tokenizer joins characters across the space between two words (checked against their files;
else a text is one word), so a word is tokenized where it is new to the task and its ids are taken to its places.

Texts go through in batches of about ``BATCH_BYTES``, a longer text alone. The table of id pairs is
broadcast behind a checked bound, else joined by shuffle with frequent pairs salted.

Defined results: a null or empty text, and one whose joined A or B bytes differ from a space and the text,
has no tokens: zeros and an empty ``groups_sha256``; every row is a document of its own, so repeated
rows repeat their result and add to the counts once each; null ids and extra columns play no part; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.common import staged
from formlake.llm.textkit import small_batches
from formlake.operators.joins import lookup_join, with_own_lookups

BATCH_BYTES = 1 << 20
CACHE = 400_000  # words whose ids a task remembers beyond its batch
# before a space that stands between characters no pattern takes for white space
_WORD_STARTS = re.compile(r"(?<=[\w!-~])(?= [\w!-~])")
_EDGE = re.compile(r"[\w!-~]")
WORDS_PER_TEXT = 1000
_NO_LISTS = pa.array([], pa.list_(pa.int32()))
_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("c", pa.int64())])
_PAIRS = "array<struct<a: int, b: int, c: bigint>>"


def byte_level_alphabet() -> dict[str, int]:
    """The character a byte-level vocabulary writes for every byte: printable Latin-1 characters
    stand for themselves, the other bytes in order for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Tokens:
    """Ids of texts and the bytes of every id, for both tokenizers."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet, listed = byte_level_alphabet(), self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(listed.values()) + 1)
        for token, i in listed.items():
            a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        b_pieces = [self.b.id_to_piece(i).replace("▁", " ") for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.encode() for i, p in enumerate(b_pieces)]
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())

        # a text may be cut before a space that stands between visible characters if A splits words as
        # byte-level vocabularies do and no B piece runs on past a space mark
        split = json.loads(self.a.to_str())
        words = split["normalizer"] is None and (split["pre_tokenizer"] or {}).get("type") == "ByteLevel" and split["pre_tokenizer"].get("use_regex", True)
        runs_on = any(x != " " and y == " " for p in b_pieces for x, y in zip(p, p[1:]))
        self.by_word, self.known, self.a_ids, self.b_ids = words and not runs_on, {}, _NO_LISTS, _NO_LISTS
        self.a_sizes = np.array([len(x) for x in a_bytes], dtype=np.int64)

    def words(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(words without the space before them, words before every text) of the texts."""
        parts = [_WORD_STARTS.split(t) if self.by_word else [t] for t in texts]
        flat = [w[1:] if k else w for part in parts for k, w in enumerate(part)]
        return flat, np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)

    def _a_ids(self, plain: list[str], others: list[str]) -> pa.ListArray:
        """The A ids of words. ``plain`` ones start and end as words inside a text do: they are tokenized
        in texts of many, whose ids are dealt out by their byte lengths; the others one by one."""
        texts = ["".join(" " + w for w in plain[k : k + WORDS_PER_TEXT]) for k in range(0, len(plain), WORDS_PER_TEXT)]
        each = [np.array(e.ids, dtype=np.int32) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int32), *each])
        sizes = np.fromiter((len(w.encode()) + 1 for w in plain), np.int64, len(plain))
        ends = np.searchsorted(np.cumsum(self.a_sizes[ids]), np.cumsum(sizes), side="left") + 1
        dealt = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
        rest = [e.ids for e in self.a.encode_batch_fast([" " + w for w in others], add_special_tokens=False)]
        return pa.concat_arrays([dealt, pa.array(rest, pa.list_(pa.int32()))])

    def places(self, words: list[str]) -> pa.Array:
        """Where the remembered id lists have each word; new words are tokenized first."""
        distinct = dict.fromkeys(words)
        fresh = [w for w in distinct if w not in self.known]
        if len(self.known) + len(fresh) > CACHE:
            self.known, fresh, self.a_ids, self.b_ids = {}, list(distinct), _NO_LISTS, _NO_LISTS
        plain = [w for w in fresh if self.by_word and w and _EDGE.match(w[0]) and _EDGE.match(w[-1])]
        taken = set(plain)
        others = [w for w in fresh if w not in taken]
        fresh = plain + others
        self.known.update(zip(fresh, range(len(self.a_ids), len(self.a_ids) + len(fresh))))
        self.a_ids = pa.concat_arrays([self.a_ids, self._a_ids(plain, others)])
        self.b_ids = pa.concat_arrays([self.b_ids, pa.array(self.b.encode(fresh, num_threads=1), pa.list_(pa.int32()))])
        return pa.array(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))

    def lists(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """The A and B ids of every text; none where their bytes are not a space and the text."""
        flat, first = self.words(texts)
        place, out = self.places(flat), []
        source = pa.array([b" " + t.encode() for t in texts], pa.binary())
        equal = pc.greater(pc.binary_length(source), 1)
        for of_word, of_id in ((self.a_ids, self.a_bytes), (self.b_ids, self.b_bytes)):
            ids = of_word.take(place)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
            ids = pa.ListArray.from_arrays(pa.array(ends[first], pa.int32()), ids.flatten())
            equal = pc.and_(equal, pc.equal(_joined(ids, of_id), source))
            out.append(ids)
        none = pa.scalar([], out[0].type)
        return tuple(pc.if_else(equal, ids, none) for ids in out)


def _joined(ids: pa.ListArray, of_id: pa.Array) -> pa.Array:
    """The bytes of every list's tokens, one after another."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, of_id.take(ids.values)), b"")


def ends(ids: pa.ListArray, of_id: pa.Array, name: str) -> pa.Table:
    """(doc, end, ``name``): of every token its document, the offset behind its last byte, and its id."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(of_id.take(flat)).cast(pa.int64()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), total])  # bytes before every token of the batch
    first = before.take(ids.offsets.slice(0, len(ids)))  # and before every document
    return pa.table({"doc": doc, "end": pc.subtract(total, first.take(doc)), name: flat})


def stretches(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, end, a, b, closes, a_ends, b_ends): the links in byte order."""
    both = a.join(b, keys=["doc", "end"], join_type="full outer", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])
    both = both.combine_chunks()
    a_ends, b_ends = pc.is_valid(both["a"]), pc.is_valid(both["b"])
    # a document's last row ends both, so nothing is filled from the next document
    return pa.table(
        {
            "doc": both["doc"], "end": both["end"], "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
            "closes": pc.and_(a_ends, b_ends), "a_ends": a_ends, "b_ends": b_ends,
        }
    )


def _lists(values: pa.Array, owner: pa.Array, n: int) -> pa.ListArray:
    """``values`` as ``n`` lists; ``owner`` is ascending and names the list of every value."""
    counts = np.bincount(owner.to_numpy(zero_copy_only=False), minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def group_texts(links: pa.Table, n_docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    closes = links["closes"].cast(pa.int64())
    group = pc.subtract(pc.cumulative_sum(closes), closes).combine_chunks()  # groups closed before the stretch
    n_groups = pc.sum(closes).as_py() or 0
    sides = []
    for side in ("a", "b"):
        of_side = links[f"{side}_ends"].combine_chunks()
        ids = links[side].combine_chunks().filter(of_side).cast(pa.string())
        sides.append(pc.binary_join(_lists(ids, group.filter(of_side), n_groups), ","))
    doc = links["doc"].combine_chunks().filter(links["closes"].combine_chunks())
    return pc.binary_join(_lists(pc.binary_join_element_wise(*sides, "|"), doc, n_docs), ";").to_pylist()


def pair_counts(links: pa.Table, by: list[str]) -> pa.Table:
    found = links.group_by(by, use_threads=False).aggregate([([], "count_all")])
    return found.rename_columns([*by, "c"] if found.column_names[-1] == "count_all" else ["c", *by]).select([*by, "c"]).combine_chunks()


def _pairs(counts: pa.Table) -> pa.StructArray:
    columns = [counts[c].combine_chunks().cast(f.type) for c, f in zip(("a", "b", "c"), _PAIR)]
    return pa.StructArray.from_arrays(columns, fields=list(_PAIR))


def align_batch(tokens: Tokens, texts: list[str]) -> dict[str, pa.Array]:
    """The columns of a batch of texts; ``partial`` has the batch's pair counts in its first row."""
    n = len(texts)
    a, b = tokens.lists(texts)
    links = stretches(ends(a, tokens.a_bytes, "a"), ends(b, tokens.b_bytes, "b"))
    doc = links["doc"].to_numpy()
    found = group_texts(links, n)
    by_doc = pair_counts(links, ["doc", "a", "b"]).sort_by("doc").combine_chunks()
    partial = _pairs(pair_counts(links, ["a", "b"]))
    return {
        "n_a": pc.list_value_length(a).cast(pa.int64()),
        "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": pa.array(np.bincount(doc[links["closes"].to_numpy()], minlength=n)),
        "n_links": pa.array(np.bincount(doc, minlength=n)),
        "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found], pa.string()),
        "groups": pa.array(found, pa.string()),
        "pairs": _lists(_pairs(by_doc), by_doc["doc"].combine_chunks(), n),
        "partial": _lists(partial, pa.array(np.zeros(len(partial), np.int64)), n),
    }


def aligned(docs: DataFrame, a_file: str, b_file: str, with_groups: bool = False) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256[, groups], pairs, partial) of every row.

    ``groups`` spells the groups out; ``pairs`` counts a document's links per id pair; the ``partial`` lists
    of all rows together hold every link once.
    """
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if with_groups else []), "pairs", "partial"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(a_file, b_file)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            made = align_batch(tokens, [t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(made[c] for c in names)], names=["row", "doc_id", *names])

    kinds = {"groups_sha256": "string", "groups": "string", "pairs": _PAIRS, "partial": _PAIRS}
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "row long, doc_id long, " + ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))


def pair_totals(rows: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links hold the id pair, and whether none of its B id's pairs has more."""
    totals = rows.select(F.explode("partial").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.c").alias("n"))
    # a B id has at most as many pairs as A has ids, so a window holds a bounded group
    return totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def alignment(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text)."""
    # written once: the row numbers stay, and neither tokenizer runs twice
    rows = staged(aligned(docs, a_file, b_file), "alignment")
    totals = staged(pair_totals(rows), "alignment-pairs")

    def joined() -> DataFrame:
        each = rows.select("row", F.explode("pairs").alias("p")).select("row", "p.a", "p.b", "p.c")
        known = lookup_join(each, totals, ["a", "b"], "inner")
        n_best = F.sum(F.when(F.col("best"), F.col("c")).otherwise(0)).alias("n_best")
        sums = known.groupBy("row").agg(n_best, F.sum(F.col("c") * F.col("n")).alias("count_sum"))
        out = rows.drop("pairs", "partial").join(sums, "row", "left")
        filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
        return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256")

    return with_own_lookups(joined)
