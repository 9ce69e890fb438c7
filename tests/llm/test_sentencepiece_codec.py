import hashlib
import random
import struct
from types import SimpleNamespace

import numpy as np
import pytest
import sentencepiece

from tollgate.llm import queries, sentencepiece_codec as codec

STRANGE = ["▁a ▁▁ b", "<s> </s> <unk> <0x41>", "\x00 �", "日本語テキスト", "a" * 3000, "aaaa aaa aa", "  lead and trail  ", "tab\tnew\nline", "🇩🇪👩‍👩‍👧"]


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_FILE)


def sha(ids):
    return hashlib.sha256(b"".join(struct.pack("<i", i) for i in ids)).hexdigest()


def test_query_equals_sentencepiece(spark, sf_dir, corpus, own):
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(STRANGE))]
    got = {r["doc_id"]: r for r in queries.op1_sentencepiece(spark, sf_dir(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = own.encode(text or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), sha(ids)), text
        assert got[i]["parity"]
        assert got[i]["round_trip"] == (own.decode(ids) == (text or "")), text


def test_decoding_equals_sentencepiece(docs, corpus, own):
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(STRANGE))]
    out = codec.decode(codec.encode(docs(rows), queries.MODEL_FILE), queries.MODEL_FILE)
    assert {r["id"]: r["text"] for r in out.collect()} == {i: own.decode(own.encode(t or "")) for i, t in rows}


def test_words_forgotten_are_encoded_again(corpus):
    with open(queries.MODEL_FILE, "rb") as f:
        both = codec.Codec(f.read(), 2, words=50)
    said = [t or "" for _, t in corpus]
    for _ in range(2):
        for at in range(0, len(said), 9):
            assert both.encode(said[at : at + 9]) == both.reference(said[at : at + 9])


def test_words_of_the_generation_before_are_not_encoded_again():
    with open(queries.MODEL_FILE, "rb") as f:
        both = codec.Codec(f.read(), 2, words=2)
    both.encode(["one two three"])
    both.encode(["four"])
    asked, fast = [], both.fast
    both.fast = SimpleNamespace(encode_batch_fast=lambda new, **how: asked.extend(new) or fast.encode_batch_fast(new, **how))
    texts = ["one two three", "four"]
    assert both.encode(texts) == both.reference(texts) and asked == []


def test_words_are_cut_before_their_marks(corpus):
    with open(queries.MODEL_FILE, "rb") as f:
        both = codec.Codec(f.read(), 2)
    assert both.split("") == [] and both.split("a\x00▁b") == ["a\x00", "▁b"] and both.split("▁▁a▁b") == ["▁▁a", "▁b"]
    for text in [t or "" for _, t in corpus] + STRANGE:
        words = both.split(both.normalise(text))
        assert "".join(words) == both.normalise(text) and all(words) and not any("▁" in w.lstrip("▁") for w in words)


def test_repeated_rows_null_ids_and_empty_tables(docs):
    got = codec.encode(docs([(1, "a b"), (1, "a b"), (None, "c"), (2, None)]), queries.MODEL_FILE).collect()
    assert sorted((r["id"] or 0, r["n_tokens"] > 0) for r in got) == [(0, True), (1, True), (1, True), (2, False)]
    assert codec.encode(docs([]), queries.MODEL_FILE).collect() == []


def message(number, kind, payload):
    head = number << 3 | kind
    size = b"" if kind != 2 else bytes([len(payload) & 127 | 128, len(payload) >> 7])
    return (bytes([head]) if head < 128 else bytes([head & 127 | 128, head >> 7])) + size + payload


def unigram_model(pieces, remove_extra):
    raw = b""
    for piece, score, kind in pieces:
        own = message(1, 2, piece.encode()) + message(2, 5, struct.pack("<f", score)) + message(3, 0, bytes([kind]))
        raw += message(1, 2, own)
    raw += message(2, 2, message(3, 0, b"\x01") + message(35, 0, b"\x01"))
    return raw + message(3, 2, message(1, 2, b"identity") + message(3, 0, b"\x01") + message(4, 0, bytes([remove_extra])) + message(5, 0, b"\x01"))


@pytest.mark.parametrize("remove_extra", [0, 1])
def test_unigram_scores_and_byte_fallback(remove_extra):
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{b:02X}>", -20, 6) for b in range(256))]
    rng = random.Random(4)
    parts = sorted({"".join(rng.choices("abc▁", weights=[4, 4, 4, 1], k=rng.randrange(1, 5))) for _ in range(60)})
    pieces += [(p, -rng.uniform(1, 12), 1) for p in parts if p.strip("▁")]
    pieces += [(c, -9.5, 1) for c in "abc▁" if c not in parts or c == "▁"]
    raw = unigram_model(pieces, remove_extra)
    both = codec.Codec(raw, 1)
    assert both.model.kind == codec.UNIGRAM and both.model.byte_fallback
    texts = ["".join(rng.choices("abc  dé", k=rng.randrange(1, 30))) for _ in range(300)] + ["", " ", "a"]
    want = both.own.encode(texts)
    scores = [s for _, s, _ in pieces]
    for t, a, b in zip(texts, [np.frombuffer(i, "<i4").tolist() for i in both.encode(texts)], want, strict=True):
        assert a == b or abs(sum(scores[i] for i in a) - sum(scores[i] for i in b)) < 1e-4, t
