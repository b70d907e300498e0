"""op9 against the library, op10 against its contract."""

import zlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from formlake.llm.bpe_count import MergeCounter, token_counts
from formlake.llm.packing import best_fit, encoder, improve, packed_documents
from tests.llm.helpers import frame, prose, rng

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", " a", "a ", "a  b", "\n", "a\n\n b", "<s> </s> <unk>", "héé ▁ x▁▁y", "日本語テキスト 😀😀 ok", "\x00x", "aaaa" * 50, " " * 100, "\t\t a",
    "x" * 3000, "<0x0A>", "\r\n a\r", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>",
]


@pytest.fixture(scope="module")
def counter():
    return MergeCounter(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_of_odd_texts(counter):
    mine, library = counter
    assert [mine.count(t) for t in ODD] == [len(library.encode(t)) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abcdethion  \n▁é日.,!0"), max_size=60))
def test_counts_of_any_text(counter, text):
    mine, library = counter
    assert mine.count(text) == len(library.encode(text))


def test_whole_texts_are_one_segment_when_pieces_cross_words(counter):
    mine, library = counter
    assert [mine.segment("▁" + t.replace(" ", "▁")) for t in ("a b", "the cat sat")] == [len(library.encode(t)) for t in ("a b", "the cat sat")]


def test_token_counts_query(spark, counter):
    texts = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (101, prose(rng(), 6000)), (101, prose(rng(), 6000)), (None, "x y")]
    got = sorted(map(tuple, token_counts(frame(spark, texts), MODEL).collect()), key=str)
    n = lambda t: len(counter[1].encode(t or ""))
    assert got == sorted(((i, len((t or "").encode()), n(t), n(t) > 4096) for i, t in texts), key=str)
    assert token_counts(frame(spark, texts).filter(F.lit(False)), MODEL).count() == 0


def test_encoder_equals_the_tokenizers_file():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [*ODD, prose(rng(), 500)]
    assert [encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_contract(spark):
    r = rng(4)
    texts = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, prose(r, r.randrange(1, 500))) for k in range(200)]
    texts += [(500, None), (501, prose(r, 9000)), (502, "w"), (502, "w"), (None, "null id")]
    rows = packed_documents(frame(spark, texts)).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for i, t in texts:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    per_doc, per_sequence = {}, {}
    for x in rows:
        per_doc.setdefault(x.doc_id, []).append(x)
        per_sequence.setdefault(x.sequence_id, []).append(x)
    assert per_doc.keys() == ids.keys()
    for i, found in per_doc.items():
        assert sum(x.length for x in found) == sum(map(len, ids[i]))
        own = ids[i][0]
        for x in found:
            part = own[x.start : x.start + x.length]
            assert x.ids_crc32 == zlib.crc32(b"".join(v.to_bytes(4, "little") for v in part)) and len(part) == x.length
            assert x.length == 1024 or x.piece == 0
    for found in per_sequence.values():
        at = 0
        for x in sorted(found, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 1024
    total = sum(x.length for x in rows)
    assert len(per_sequence) <= 1.05 * -(-total // 1024) + 1
    assert packed_documents(frame(spark, texts).filter(F.lit(False))).count() == 0


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 100), max_size=60))
def test_local_search_keeps_pieces_and_never_adds_bins(lengths):
    lengths = sorted(lengths, reverse=True)
    first = best_fit(lengths, 100)
    better = improve([list(b) for b in first], lengths, 100)
    assert sorted(i for b in better for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in better)
    assert len(better) <= len(first)


def test_exchanges_empty_bins():
    r = rng(6)
    lengths = sorted((r.randint(250, 600) for _ in range(2000)), reverse=True)
    first = best_fit(lengths, 1024)
    assert len(improve([list(b) for b in first], lengths, 1024)) < len(first)


@pytest.mark.parametrize("seed,low,high", [(1, 180, 519), (2, 250, 600), (3, 40, 400), (4, 300, 345)])
def test_search_ends_where_no_step_is_left(seed, low, high):
    r, capacity = rng(seed), 1024
    lengths = sorted((r.randint(low, high) for _ in range(240)), reverse=True)
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    if len(bins) == -(-sum(lengths) // capacity):
        return
    fill = [sum(lengths[i] for i in b) for b in bins]
    for t, target in enumerate(bins):
        for k, source in enumerate(bins):
            if k == t or fill[k] > fill[t] or fill[t] == capacity:
                continue
            own = [lengths[i] for i in source]
            gains = set(own) | {a - lengths[j] for a in own for j in target}
            gains |= {a + b - lengths[j] for x, a in enumerate(own) for b in own[x + 1 :] for j in target}
            assert not any(0 < g <= capacity - fill[t] for g in gains)
