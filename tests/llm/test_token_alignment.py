"""Token alignment against a loop over bytes."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from formlake.llm.token_alignment import alignment, aligned, byte_level_alphabet
from tests.llm.helpers import frame, prose, rng

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """Per text (n_a, n_b, n_groups, links, groups) by walking over the bytes of both token lists."""
    a_tok = tokenizers.Tokenizer.from_file(A_FILE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    alphabet = byte_level_alphabet()
    out = []
    for text in texts:
        text = text or ""
        want = (" " + text).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            out.append((0, 0, 0, [], ""))
            continue
        owner_a = [k for k, t in enumerate(a_bytes) for _ in t]
        owner_b = [k for k, t in enumerate(b_bytes) for _ in t]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, left, right = [], [], []
        for at in range(len(want)):
            if at + 1 == len(want) or owner_a[at + 1] != owner_a[at]:
                left.append(str(a[owner_a[at]]))
            if at + 1 == len(want) or owner_b[at + 1] != owner_b[at]:
                right.append(str(b[owner_b[at]]))
            if at + 1 == len(want) or (owner_a[at + 1] != owner_a[at] and owner_b[at + 1] != owner_b[at]):
                groups.append(",".join(left) + "|" + ",".join(right))
                left, right = [], []
        out.append((len(a), len(b), len(groups), [(a[x], b[y]) for x, y in links], ";".join(groups)))
    return out


def brute_force(rows):
    found = plain([t for _, t in rows])
    counts = Counter(pair for *_, links, _ in found for pair in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for (doc, _), (n_a, n_b, n_groups, links, groups) in zip(rows, found):
        n_best = sum(counts[p] == highest[p[1]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((doc, n_a, n_b, n_groups, len(links), n_best, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def cases():
    r = rng(13)
    rows = [(i, prose(r, r.randrange(1, 80))) for i in range(60)]
    rows += [(100, None), (None, "null id text"), (101, ""), (102, " "), (103, "  two  spaces  "), (104, "line\nline\n\n\ttab"), (105, "a▁b")]
    rows += [(106, "日本語のテキスト 🙂🙂 ünïcode Ærø"), (107, "<s></s><unk><|endoftext|> <0x41>"), (108, "x" * 3000), (109, "  nbsp ﬁ ①"), (110, "\x00\x01 control")]
    rows += [(111, "the same text"), (111, "the same text"), (112, prose(r, 6000)), (113, "é combining"), (114, "1234567890 3.14159 www.example.com/a?b=c")]
    return rows


def test_equals_a_loop_over_bytes(spark):
    rows = cases()
    found = alignment(frame(spark, rows).repartition(3), A_FILE, B_FILE)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)


def test_pairs_joined_by_shuffle_and_salted(spark):
    rows = [(i, "the same few words again") for i in range(40)] + [(99, "other words")]
    spark.conf.set("formlake.broadcast.maxRows", "0")
    spark.conf.set("formlake.skew.rowsPerTask", "5")
    try:
        assert sorted(map(tuple, alignment(frame(spark, rows), A_FILE, B_FILE).collect()), key=repr) == brute_force(rows)
    finally:
        spark.conf.unset("formlake.broadcast.maxRows")
        spark.conf.unset("formlake.skew.rowsPerTask")


def test_groups_spelled_out(spark):
    rows = cases()
    found = {r["row"]: r["groups"] for r in aligned(frame(spark, rows).coalesce(1), A_FILE, B_FILE, with_groups=True).select("row", "groups").collect()}
    assert [found[k] for k in sorted(found)] == [p[4] for p in plain([t for _, t in rows])]


def test_empty_table(spark):
    assert alignment(frame(spark, []), A_FILE, B_FILE).collect() == []


@pytest.mark.parametrize("texts", [["", None], ["a▁b", ""]])
def test_only_texts_without_tokens(spark, texts):
    rows = list(enumerate(texts))
    assert sorted(map(tuple, alignment(frame(spark, rows), A_FILE, B_FILE).collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("seed", range(4))
def test_ids_by_word_are_those_of_whole_texts(seed):
    from formlake.llm.token_alignment import Tokens

    r = rng(100 + seed)
    alphabet = ["a", "The", "é", "e\u0301", "\u0301", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u180e", "\u200b", "\x1c", "'s", "'", ".", "!", "_", "1", "42", "日本", "🙂", "▁", "<s>", "<|endoftext|>", "\x85", "-", "ñ", "½", "²"]
    texts = ["".join(r.choice(alphabet) + (" " if r.random() < 0.4 else "") for _ in range(r.randrange(1, 60))) for _ in range(500)]
    tokens = Tokens(A_FILE, B_FILE)
    assert tokens.by_word
    flat, first = tokens.words(texts)
    place = tokens.places(flat[: len(flat) // 2]).to_pylist() and tokens.places(flat)  # some words are known already
    a, b = tokens.a_ids.take(place).to_pylist(), tokens.b_ids.take(place).to_pylist()
    for k, text in enumerate(texts):
        own = range(first[k], first[k + 1])
        assert [i for w in own for i in a[w]] == tokens.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert [i for w in own for i in b[w]] == tokens.b.encode(text), repr(text)
