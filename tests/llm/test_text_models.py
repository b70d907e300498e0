"""op4, op6 and op8: brute force for matches, held-out accuracy for trained models."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from formlake.llm import decontaminate
from formlake.llm.decontaminate import Segments, drop_contaminated, find_matches, normalised
from formlake.llm.language_id import KneserNey, accept_languages, identify, learn, limits_of
from formlake.llm.queries import op6_language_id, op8_toxicity
from formlake.llm.toxicity import FEATURES, GAIN, LEAST, chosen_words, coded, score_toxicity, word_gains, word_sets
from tests.conftest import SF_MID
from tests.llm.helpers import edited, frame, prose, rng


def least_edits(pattern, text):
    """Edits of the best match of ``pattern`` anywhere in ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def mutated(r, text, n):
    out = list(text)
    for _ in range(n):
        k, at = r.randrange(3), r.randrange(len(out))
        if k == 0:
            out[at] = r.choice("xyz")
        elif k == 1:
            del out[at]
        else:
            out.insert(at, r.choice("xyz"))
    return "".join(out)


def test_segments_match_brute_force():
    r = rng(7)
    items = [(k, prose(r, 5 + 3 * k)) for k in range(8)]
    segments = Segments(items)
    texts = []
    for k in range(80):
        _, item = r.choice(items)
        texts.append(normalised(prose(r, 10) + " " + mutated(r, item, r.randrange(0, 2 + len(item) // 8)) + " " + prose(r, 10)))
    got = segments.matches(texts)
    for text, found in zip(texts, got):
        want = {}
        for s, code in enumerate(segments.codes):
            pattern = code.tobytes().decode("utf-32-le")
            e = least_edits(pattern, text)
            if e <= segments.edits[s]:
                want[segments.item[s]] = min(e, want.get(segments.item[s], 99))
        assert {k: v[0] for k, v in found.items()} == want


def test_find_and_drop(spark, monkeypatch):
    r = rng(9)
    items = [(1, prose(r, 30)), (2, prose(r, 12)), (2, prose(r, 12)), (3, None), (4, "too short"), (None, prose(r, 20)), (5, "É Ñ " + prose(r, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("matches", F.lit(1))
    leak = lambda k: prose(r, 40) + "\n" + items[k][1].upper().replace(" ", "  ") + " " + prose(r, 40)
    docs = frame(spark, [(0, None), (1, ""), (10, leak(0)), (11, leak(1)), (11, leak(2)), (12, leak(6)), (13, prose(r, 20_000)), (None, leak(0)), (14, "Far  TOO short, it is"), (15, "too shorty, not too\u00e9 short")])
    for size in (10_000_000, 150):  # one block of items, then several
        monkeypatch.setattr(decontaminate, "INDEX_CHARS", size)
        got = sorted(((x.doc_id, x.item_id) for x in find_matches(docs, benchmark).collect()), key=str)
        assert got == sorted([(10, 1), (11, 2), (11, 2), (12, 5), (None, 1), (14, 4)], key=str)
        left = drop_contaminated(docs, benchmark)
        assert left.columns == docs.columns
        assert sorted(x.doc_id for x in left.collect()) == [0, 1, 13, 15]
    assert find_matches(docs.filter(F.lit(False)), benchmark).count() == 0
    assert drop_contaminated(docs, benchmark.filter(F.lit(False))).count() == docs.count()


def test_short_items_are_found_at_word_borders(spark):
    r = rng(14)
    alphabet = "ab "
    items = [(k, "".join(r.choice(alphabet) for _ in range(r.randrange(0, 30)))) for k in range(60)] + [(100, "What is the capital of Peru?"), (101, "42"), (102, "a b"), (102, "b"), (None, "ba ab"), (103, "é")]
    texts = [(k, "".join(r.choice(alphabet + alphabet + ".") for _ in range(400))) for k in range(30)]
    texts += [(50, "so: what IS the\ncapital of peru? Lima"), (51, "what is the capital of perus? no"), (52, "142 42a 42é"), (53, "is it 42."), (54, None), (55, "")]
    want = Counter()
    for doc, raw in texts:
        text = normalised(raw)
        for item, own in {(i if i is not None else t, normalised(t)) for i, t in items}:
            places = [m.start() for m in re.finditer(rf"(?<!\w)(?={re.escape(own)}(?!\w))", text)] if own else []
            if places:
                key = (doc, item if isinstance(item, int) else None)
                want[key] = min(want.get(key, 10**9), places[0]) if key in want else places[0]
    found = find_matches(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id): x.start for x in found} == dict(want) and all(x.edits == 0 for x in found)
    # items without a q-gram drop nothing, the others do
    tiny = [i for i in items if len(normalised(i[1])) < decontaminate.Q]
    assert drop_contaminated(frame(spark, texts), spark.createDataFrame(tiny, "item_id long, text string")).count() == len(texts)
    left = drop_contaminated(frame(spark, texts), spark.createDataFrame(items[60:61], "item_id long, text string"))
    assert {x.doc_id for x in left.collect()} == {k for k, _ in texts} - {50}


def test_items_without_an_id(spark, monkeypatch):
    r = rng(12)
    items = [(1, prose(r, 30)), (None, prose(r, 20)), (None, prose(r, 25))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(k, prose(r, 20) + " " + items[k][1] + " " + prose(r, 20)) for k in range(3)] + [(3, items[0][1] + " " + items[1][1]), (4, prose(r, 60)), (5, items[1][1] + " " + items[2][1])])
    for size in (10_000_000, 150):
        monkeypatch.setattr(decontaminate, "INDEX_CHARS", size)
        got = Counter((x.doc_id, x.item_id) for x in find_matches(docs, benchmark).collect())
        assert got == Counter([(0, 1), (1, None), (2, None), (3, 1), (3, None), (5, None), (5, None)])
        assert [x.doc_id for x in drop_contaminated(docs, benchmark).collect()] == [4]


def test_kneser_ney_sums_to_one():
    r = rng(1)
    text = "\0\0\0" + "".join(r.choice("abc ") for _ in range(4000))
    code = np.array([ord(c) for c in text], dtype=np.uint64)
    grams = sum(code[3 - k : len(code) - k] << np.uint64(16 * k) for k in range(4))
    keys, counts = np.unique(grams, return_counts=True)
    model = KneserNey(keys, counts, 4)
    for context in ("abc", "zzz", "a b"):
        head = sum(ord(c) << 16 * (3 - k) for k, c in enumerate(context))
        every = np.array([head + ord(c) for c in "abc "], dtype=np.uint64)
        assert np.exp(model.logp(every)).sum() == pytest.approx(1, abs=1e-9)


def test_language_accuracy_on_held_out_rows(spark):
    found = op6_language_id(spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == 1000 and all(0 <= x.score <= 1 for x in rows)
    held = [x for x in rows if x.held_out]
    assert sum(x.lang == x.lang_pred for x in held) >= 0.97 * len(held)
    assert sum(x.accepted for x in rows) >= 0.98 * len(rows)


def test_language_of_awkward_rows(spark):
    r = rng(3)
    texts = [(k, prose(r, 40) if k % 2 else "".join(r.choice("xyzq wv") for _ in range(200))) for k in range(60)]
    odd = [(100, None), (101, ""), (102, "123 ... !!"), (103, "a"), (104, "日本語"), (105, "\x00k\x00a"), (None, texts[1][1]), (107, prose(r, 20_000)), (1, texts[1][1])]
    docs = frame(spark, texts + odd)
    rows = identify(docs).collect()
    assert len(rows) == len(texts) + len(odd)
    got = {x.doc_id: x for x in rows}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 and not got[k].accepted for k in (100, 101, 102))
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") for k, _ in texts)
    assert got[107].lang_pred == "en" and got[107].accepted
    left = accept_languages(docs)
    assert left.columns == docs.columns and {100, 101, 102}.isdisjoint(x.doc_id for x in left.collect())
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {x.lang_pred for x in identify(none).collect()} == {"und"}
    assert identify(docs.filter(F.lit(False))).count() == 0


def test_models_hold_every_gram(spark):
    r = rng(11)
    letters = "".join(map(chr, range(0x4E00, 0x4E00 + 900)))
    text = "".join(r.choice(letters) for _ in range(250_000))
    (model,), langs = learn(spark.createDataFrame([("zh", text)], "lang string, text string"))
    padded = "\0\0\0" + text
    # 250,000 characters at random: nearly every gram is a distinct one, and met once
    assert langs == ["zh"] and len(model.orders[3][0]) == len({padded[k : k + 4] for k in range(len(text))}) > 240_000
    assert len(model.orders[0][0]) == 900


def test_limits_count_every_row(spark):
    # 30 rows of a rare language among 30,000: its limits are its own; a language of 5 rows has the pooled ones
    row = F.when(F.col("id") < 30, "rare").when(F.col("id") < 35, "few").otherwise("en")
    entropy = F.when(F.col("id") < 30, 4.0 + F.col("id") / 100).otherwise(2.0 + F.pmod("id", F.lit(101)) / 100)
    seen = spark.range(30_000).select(row.alias("lang"), entropy.alias("entropy"))
    got = {x.lang: (x["mean"], x.spread) for x in limits_of(seen).collect()}
    assert got["rare"] == (pytest.approx(4.145, abs=0.01), pytest.approx(1.4826 * 0.075, abs=0.02))
    assert got["en"] == (pytest.approx(2.5, abs=0.01), pytest.approx(1.4826 * 0.25, abs=0.02)) and got["few"] == pytest.approx(got["en"], abs=0.01)


def test_toxicity_on_held_out_rows(spark):
    found = op8_toxicity(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "toxic")
    held = [x for x in found.join(labels, "doc_id").collect() if x.held_out]
    good, bad = [x.score for x in held if not x.toxic], [x.score for x in held if x.toxic]
    auc = sum((g < b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert found.count() == 1000 and auc > 0.75


def test_toxicity_learns_and_takes_awkward_rows(spark):
    r = rng(4)
    vile = ["vilest", "rotten", "nastier"]
    texts = [(k, edited(r, prose(r, 50), 0.02) + (" " + " ".join(vile) if k % 5 == 0 else "")) for k in range(400)]
    odd = [(900, None), (901, ""), (902, "Vilest ROTTEN nastier"), (903, prose(r, 20_000)), (None, "rotten"), (0, texts[0][1])]
    docs = frame(spark, texts + odd)
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(0, 300)] * 2 + [(None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    rows = score_toxicity(docs, labels, F.col("doc_id") % 4 != 1).collect()
    assert len(rows) == len(texts) + len(odd) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    got = {x.doc_id: x.predicted for x in rows}
    assert all(got[k] == (k % 5 == 0) for k, _ in texts)
    assert (got[900], got[901], got[902], got[903]) == (0, 0, 1, 0)
    # repeated label rows count once
    again = labels.unionByName(labels.filter("toxic = 1")).unionByName(labels.filter("toxic = 1"))
    assert sorted(x.score for x in rows) == pytest.approx(sorted(x.score for x in score_toxicity(docs, again, F.col("doc_id") % 4 != 1).collect()))
    assert max(x.score for x in score_toxicity(docs, labels.filter("toxic = 0")).collect()) < 1e-9
    assert score_toxicity(docs.filter(F.lit(False)), labels.filter(F.lit(False))).count() == 0


def _word_hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return {int(h) for _, _, hashes, _ in word_sets(data, np.array([0, len(data)])) for h in hashes}


def test_toxicity_features_equal_brute_force_and_long_texts_stay_bounded(spark):
    rng = np.random.default_rng(5)
    bad, common = [f"insult{k}" for k in range(40)], [f"word{k}" for k in range(300)]
    rows = []
    for k in range(240):
        toxic = k % 3 == 0
        own = rng.choice(common, 30).tolist() + rng.choice(bad, 6 if toxic else int(rng.integers(0, 2))).tolist()
        rows.append((toxic, " ".join(own)))
    # thousands of words of their own: none is a feature
    rows += [(True, " ".join(f"own{k}" for k in range(60_000))), (False, " ".join(f"other{k}" for k in range(60_000))), (True, None), (False, ""), (False, "--")]
    rows += rows[:1] * 2
    sample = spark.createDataFrame(rows, "toxic boolean, text string")
    sets = [(toxic, _word_hashes(text or "")) for toxic, text in rows]
    sets = [(toxic, words) for toxic, words in sets if words]
    sizes = {kind: sum(toxic == kind for toxic, _ in sets) for kind in (True, False)}
    counts = {True: {}, False: {}}
    for toxic, words in sets:
        for w in words:
            counts[toxic][w] = counts[toxic].get(w, 0) + 1
    want = {}
    for w, here in counts[True].items():
        there = counts[False].get(w, 0)
        if here + there < LEAST or here < 2 or here * sizes[False] < there * sizes[True]:
            continue
        both = (here + there) / (sizes[True] + sizes[False])
        gain = here * np.log(here / (both * sizes[True])) + there * np.log(max(there, 1) / (both * sizes[False]))
        if gain >= GAIN:
            want[w] = gain
    got = {x.word % 2**64: x.gain for x in word_gains(sample).collect()}
    assert want and got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
    words = chosen_words(sample)
    assert words.tolist() == sorted(want) and len(words) <= FEATURES
    assert set(chosen_words(sample, 3).tolist()) <= set(want)
    places = {w: i for i, w in enumerate(words.tolist())}
    seen = sorted((x.toxic, sorted(x.codes)) for x in coded(sample, words).collect())
    assert seen == sorted((toxic, sorted(places[w] for w in own if w in places)) for toxic, own in sets)
    assert coded(sample, words[:0]).count() == len(sets)
    assert len(chosen_words(sample.filter(F.lit(False)))) == 0
