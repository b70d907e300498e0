"""op3 against brute force over all 200-byte windows, with the awkward rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from formlake.llm import suffix_dedup
from formlake.llm.suffix_dedup import SuffixFamily, cut_repeats, drop_repeats
from tests.llm.helpers import frame, prose, rng


def brute(texts, length=200):
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(x[k : k + length] for _, x in data for k in range(len(x) - length + 1))
    out = []
    for i, x in data:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    r = rng(2)
    p = [prose(r, 60) for _ in range(6)]
    texts = [(0, None), (1, ""), (2, "short"), (3, p[0][:199]), (4, p[0][:200]), (5, "x" + p[0][:200] + "y"), (6, "a" * 700), (7, "ab" * 300)]
    texts += [(10 + k, prose(r, 5 + k) + " " + p[1] + " " + prose(r, 9)) for k in range(25)]  # a shared passage
    texts += [(50 + k, p[2]) for k in range(8)]  # copies
    texts += [(60, p[3] + " " + p[3]), (61, p[4][:250]), (62, p[4][30:290]), (63, p[4][60:]), (64, "é" * 150 + p[5][:180]), (65, "é" * 150 + p[5][:181])]
    texts += [(70, prose(r, 4000)), (71, prose(r, 30) + texts[8][1]), (None, p[5]), (None, p[5]), (80, p[5]), (80, p[5])]
    texts += [(90, "\0" * 450), (91, "q" + "\0" * 230)]
    return texts


def test_cut_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_WINDOWS", 300)
    texts = cases()
    got = cut_repeats(frame(spark, texts)).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(texts)


def test_no_core_fills_a_shard(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CORE_WINDOWS", 400, raising=False)
    r, held, matched = rng(8), [], suffix_dedup._matched

    def seen(cells, *args):
        held.extend(cells.groupBy("core").agg(F.sum("n").alias("n")).collect())
        return matched(cells, *args)

    monkeypatch.setattr(suffix_dedup, "_matched", seen)
    p = prose(r, 60)
    # one passage with different text before and after it, also from within
    texts = cases() + [(200 + k, f"{prose(r, 30)} {p[k % 7:]} {prose(r, 30)}") for k in range(60)]
    got = cut_repeats(frame(spark, texts)).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(texts)
    assert held and max(x.n for x in held) <= 400


@pytest.mark.parametrize("tile", [1, 230, 1000])
def test_tiles_of_long_texts_change_nothing(spark, monkeypatch, tile):
    monkeypatch.setattr(suffix_dedup, "TILE_BYTES", tile)
    r = rng(4)
    p = [prose(r, 70) for _ in range(4)]
    texts = [(k, prose(r, 90 * k) + " " + p[k % 4] + " " + prose(r, 5)) for k in range(1, 7)] + [(20, p[0] + p[1] + p[0]), (21, "z" * 900), (22, p[3][:200]), (23, None)]
    got = cut_repeats(frame(spark, texts)).select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute(texts)


def test_tiles_cover_every_window_once():
    offsets = np.array([0, 0, 5, 40, 41, 300, 300, 310])
    for length, limit in ((3, 7), (3, 1), (20, 30), (50, 1000)):
        windows = Counter()
        for i, at, own in suffix_dedup.tiles(offsets, length, limit):
            assert own[0] == 0 and own[-1] <= limit + length - 1 or len(own) > 2 or own[-1] <= limit
            for a, b in zip(own[:-1], own[1:]):
                windows.update(range(at + a, at + max(a, b - length + 1)))
        assert windows == Counter(w for a, b in zip(offsets[:-1], offsets[1:]) for w in range(a, max(a, b - length + 1)))


def test_many_equal_rows_are_settled_by_a_count(spark):
    r = rng(6)
    p = prose(r, 60)
    copied = prose(r, 20) + " " + p
    some = [(1, copied), (2, "x " + p + " y"), (3, prose(r, 80)), (4, "short")]
    texts = some + [(1, copied)] * 19_999 + [(None, copied)] * 300 + [(4, "short")] * 50 + [(5, None)] * 40
    got = cut_repeats(frame(spark, texts).repartition(6), with_text=True)
    rows = Counter(tuple(x) for x in got.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    # equal rows have equal results: two of each stand for all in the brute force
    few = brute(some + [(1, copied), (None, copied), (None, copied), (4, "short"), (5, None), (5, None)])
    times = {1: 20_000, None: 300, 4: 51, 5: 40}
    assert rows == Counter({x: times.get(x[0], 1) for x in few})
    assert {x.text for x in got.filter("rest.doc_id = 1 or rest.doc_id is null").select("text").distinct().collect()} == {""}


def test_stage_keeps_columns_and_cuts_text(spark):
    r = rng(3)
    p = prose(r, 50)
    docs = frame(spark, [(1, "Start " + p + " end"), (2, "Other " + p + " tail"), (3, "alone"), (4, None)])
    out = drop_repeats(docs)
    assert out.columns == docs.columns
    rows = {x.doc_id: x for x in out.collect()}
    assert rows[1].text == "Start" + "end" or len(rows[1].text) < 20
    assert rows[3].text == "alone" and rows[4].text == ""
    assert all(x.n_chars == len(x.text) for x in rows.values())


def test_empty_table(spark):
    assert cut_repeats(frame(spark, [(1, "x")]).filter(F.lit(False))).count() == 0


def test_levels_grow_geometrically():
    family, r = SuffixFamily(), rng(1)
    keys = np.array([prose(r, 3).encode()[:12].ljust(12, b".") for _ in range(640)], dtype="S12")
    flags = np.zeros(len(keys), bool)
    for part in np.array_split(np.arange(len(keys)), 16):
        family.add(keys[part], part, flags)
        sizes = [len(k) for k, _ in family.levels]
        assert all(a.bit_length() > b.bit_length() for a, b in zip(sizes, sizes[1:]))
    count = Counter(keys.tolist())
    assert flags.tolist() == [count[k] > 1 or bool(flags[i]) for i, k in enumerate(keys.tolist())]
    # of a string met often, every start of a batch and at least one start before it is marked
    assert {k for k, f in zip(keys.tolist(), flags) if f} == {k for k, c in count.items() if c > 1}
