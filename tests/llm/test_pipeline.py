"""The corpus pipeline: every stage against a plain version on its own input, and run() as their chain."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

import corpus_pipeline
from formlake.llm.decontaminate import normalised
from tests.conftest import SF_SMALL
from tests.llm.test_suffix_dedup import brute

SPACES = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def chain(spark):
    """(name, input rows, output DataFrame) of every stage at the smallest scale."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_SMALL).cache()
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_stages_and_their_columns(chain, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "packing"]
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert all(chain[n][1].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])


def test_language_stage_keeps_clean_rows_whole(chain):
    before, after = map(texts, chain["language_id"])
    assert set(after) <= set(before) and all(after[k] == before[k] for k in after)
    assert len(after) >= 0.9 * len(before) and not any(t is None for t in after.values())


def test_near_duplicates_leave_one_of_each_group(chain):
    before, after = map(texts, chain["near_dedup"])
    sets, group = {k: shingles(t) for k, t in before.items()}, {k: k for k in before}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    holders = defaultdict(list)
    for k, own in sets.items():
        for s in own:
            holders[s].append(k)
    shared = Counter((a, b) for ks in holders.values() for a in ks for b in ks if a < b)
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            group[max(root(a), root(b))] = min(root(a), root(b))
    assert set(after) == {k for k in before if root(k) == k}
    assert all(after[k] == before[k] for k in after)


def test_repeated_strings_are_cut(chain):
    before, after = map(texts, chain["suffix_dedup"])
    assert set(after) == set(before)
    for doc, _, gone, _, _ in brute(sorted(before.items())):
        if gone == 0:
            assert after[doc] == before[doc]
        else:
            assert len(before[doc].encode()) - len(after[doc].encode()) in range(gone, gone + 8)


def test_contaminated_documents_go_and_clean_ones_stay(chain, spark):
    before, after = map(texts, chain["decontaminate"])
    items = [normalised(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    quoting = {k for k, t in before.items() if any(len(i) >= 30 and i in normalised(t) for i in items)}
    assert not quoting & set(after)
    # what else went shares at least a stretch of an item
    grams = {i[k : k + 12] for i in items for k in range(len(i) - 11)}
    for k in set(before) - set(after) - quoting:
        text = normalised(before[k])
        assert any(text[j : j + 12] in grams for j in range(len(text)))
    assert len(after) >= 0.8 * len(before)


def check_packing(rows, docs):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for own in sequences.values():
        own = sorted(own, key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert sum(r.length for r in own) <= 1024


def test_pieces_are_whole_documents(chain):
    before, after = chain["packing"]
    check_packing(after.collect(), texts(before))


def test_run_is_the_chain_of_its_stages(chain, spark):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, chain["packing"][1].select(key).collect()))
