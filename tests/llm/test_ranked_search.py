"""Reversed ranked search against a scan of all pairs."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formlake.llm.ranked_search import Heaps, ranked_search, terms, weight
from tests.llm.helpers import frame, prose, rng

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return PATTERN.findall((text or "").translate(ASCII_LOWER))


def brute_force(docs, items, k):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, own in wanted.items():
        hits = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                hits.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, h[3], -h[0]) for r, h in enumerate(sorted(hits)[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def cases():
    r = rng(11)
    docs = [(i, prose(r, r.randrange(1, 60))) for i in range(150)]
    docs += [(None, docs[3][1]), (None, None), (7, docs[7][1]), (7, docs[7][1]), (300, ""), (301, " .,;\n"), (302, None)]
    docs += [(400 + i, "Equal TEXT equal text kaban1") for i in range(40)]
    docs += [(500, "Ünïcode ünïcode ÜNÏCODE x1y2 a_b a-b 日本語 日本語 🙂"), (501, prose(r, 9000))]
    items = [(i, prose(r, r.randrange(3, 25))) for i in range(25)]
    items += [(2, items[2][1]), (3, "kaban1 extra words of another row"), (None, docs[5][1]), (60, None), (61, ""), (62, "nothingholdsthis"), (63, "text equal"), (64, "ünïcode 日本語 🙂 a b x1y2")]
    return docs, items


def test_terms_follow_the_pattern():
    for text in ["", None, "A-b_C d\x7fE\x80é", "ÀÉ aÀ 日本 x y z", "1a2B\x00c@d`e{f"]:
        assert [t.decode() for t in terms(text)] == plain_terms(text)


def test_heap_keeps_the_best_and_the_smaller_id():
    import numpy as np

    heaps = Heaps(2, 2)
    for doc, scores in [(5, [3, 0]), (9, [3, 0]), (1, [3, 4]), (2, [2, 4]), (0, [4, 4])]:
        items = np.flatnonzero(np.array(scores))
        heaps.offer(items, np.array(scores)[items], doc)
    assert sorted((-s, -d) for s, d in heaps.heaps[0]) == [(-4, 0), (-3, 1)]
    assert sorted((-s, -d) for s, d in heaps.heaps[1]) == [(-4, 0), (-4, 1)]


@pytest.mark.parametrize("limits", [{}, {"most": 7}, {"chars": 300}])
def test_equals_a_scan_of_all_pairs(spark, limits):
    docs, items = cases()
    found = ranked_search(
        frame(spark, docs).repartition(5), spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1)), k=10, **limits
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert result(found) == brute_force(docs, items, 10)


def test_few_hits_and_common_terms(spark):
    docs = [(i, "all share this") for i in range(30)]
    items = [(1, "all share"), (2, "only once")]
    assert weight(30, 30) == math.floor(1000 * math.log(62 / 61))
    assert result(ranked_search(frame(spark, docs + [(99, "once")]), spark.createDataFrame(items, "item_id long, text string"), k=3)) == brute_force(
        docs + [(99, "once")], items, 3
    )


def test_empty_tables(spark):
    none, item = frame(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(none, item).collect() == []
    assert ranked_search(frame(spark, [(1, "a")]), item.limit(0)).collect() == []
