import math
import random
import re
import zlib
from collections import Counter

import pytest

from tollgate.llm import lattice, queries
from tollgate.llm.sentencepiece_codec import BPE, UNIGRAM, Model, parse


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def segmentations(text, pieces):
    """The probability of every way to cut ``text``, one by one."""
    if not text:
        yield 1.0
    for n in range(1, len(text) + 1):
        head = text[:n]
        p = pieces.logs.get(head)
        if p is None and n == 1:
            p = sum(pieces.byte_logs[b] for b in head.encode())
        if p is not None:
            for rest in segmentations(text[n:], pieces):
                yield 10**p * rest


@pytest.fixture(scope="module")
def model():
    with open(queries.MODEL_FILE, "rb") as f:
        return parse(f.read())


def test_forward_recursion_equals_the_sum_over_all_segmentations(model):
    pieces = lattice.weigh(model, {300: 50, 5000: 7}, 3)
    for word in ("a", "the", "token", "naïve", "x😀y", "日本", "a.b,c", "aaaaaaaa"):
        assert lattice.word_score(word, pieces) == pytest.approx(math.log10(math.fsum(segmentations("▁" + word, pieces))), abs=1e-9)
    assert math.isfinite(lattice.word_score("x" * 20_000, pieces))


def test_weights_sum_to_one(model):
    for counts, ends in (({}, 0), ({300: 50, 5000: 7}, 3)):
        p = lattice.weigh(model, counts, ends)
        assert 10**p.end + sum(10**x for x in p.logs.values()) + sum(10**x for x in p.byte_logs) == pytest.approx(1, abs=1e-6)


def test_unigram_scores_are_taken_as_they_are():
    own = Model([("<unk>", 0, 2), ("▁a", math.log(0.5), 1), ("a", math.log(0.3), 1), ("▁", math.log(0.2), 1)], UNIGRAM)
    p = lattice.weigh(own, {1: 99}, 10)
    rest = 1 - 10**p.end
    assert 10 ** lattice.word_score("a", p) == pytest.approx((0.5 + 0.2 * 0.3 * rest) * rest)
    assert own.kind != BPE


def brute(rows, pieces):
    train = Counter()
    ends = 0
    for i, t in rows:
        if not held(i):
            train.update(words_of(t))
            ends += 1
    total, kinds = sum(train.values()) + ends, len(train) + (ends > 0)
    out = {}
    for i, t in rows:
        c = [train[w] for w in words_of(t)] + [ends]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (kinds + 1))) for x in c)
        score = sum(lattice.word_score(w, pieces) for w in words_of(t)) + pieces.end
        out[i] = (held(i), len(c), sum(x > 0 for x in c), total, base, score)
    return out


@pytest.mark.parametrize("chunk_bytes", [24_000_000, 2_000])
def test_scores_equal_brute_force(docs, corpus, model, chunk_bytes):
    rng = random.Random(3)
    rows = [*corpus, *((1000 + i, " ".join(rng.choices(["The", "the", "cat", "ÉTÉ", "é"], k=9))) for i in range(30))]
    got = lattice.score_texts(docs(rows), queries.MODEL_FILE, chunk_bytes).collect()
    own = lattice.sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_FILE)
    counts, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            ends += 1
            counts.update(x for w in words_of(t) for x in own.encode(w))
    want = brute(rows, lattice.weigh(model, counts, ends))
    assert len(got) == len(rows)
    for r in got:
        w = want[r["id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9) and r["score"] == pytest.approx(w[5], rel=1e-9)


def test_query_columns_and_odd_tables(spark, sf_dir, docs):
    got = queries.op7_lattice(spark, sf_dir([(1, "a b"), (1, "a b"), (None, "a b"), (2, None)])).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["train_tokens"]) for r in got) == [(1, 3, 4), (2, 1, 4)]
    assert lattice.score_texts(docs([]), queries.MODEL_FILE).collect() == []
    only_held = next(i for i in range(100) if held(i))
    r = lattice.score_texts(docs([(only_held, "the cat")]), queries.MODEL_FILE).first()
    assert (r["n_known"], r["train_tokens"]) == (0, 0) and math.isfinite(r["score"]) and r["base_score"] == pytest.approx(0)


def test_training_helps_held_out_text(docs, corpus, model):
    rows = [(i, t) for i, t in corpus if t and len(t) < 2000]
    got = lattice.score_texts(docs(rows), queries.MODEL_FILE).where("held_out").collect()
    flat = lattice.weigh(model, {}, 0)
    text = dict(rows)
    assert sum(r["score"] for r in got) > sum(sum(lattice.word_score(w, flat) for w in words_of(text[r["id"]])) + flat.end for r in got)
