import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from samples import prose

from tollgate.llm import personal_data, queries

WORDS = "the river house was built of stone and bread gute Straße calle año maison thé he went to market today".split()


@pytest.fixture(scope="module")
def field():
    return personal_data.train(personal_data.sentences(WORDS))


def luhn(number):
    back = [int(c) for c in number[::-1]]
    return (sum(back[::2]) + sum(sum(divmod(2 * c, 10)) for c in back[1::2])) % 10 == 0


def brute(text):
    """Base spans by the contract's own patterns."""
    text = text or ""
    n = lambda x: len(re.findall("[0-9]", x))
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer("[0-9]([\x20-]?[0-9])+", text):
        if 14 <= n(m[0]) <= 19 and luhn("".join(re.findall("[0-9]", m[0]))):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= n(m[0]) <= 15]
    return [f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in sorted(found)]


SAID = [
    "a@b.c x.y+z%1@mail-2.example.com. no@dot @a.b a@@b.c a@b@c.d.e é@x.y ü.a@b.c",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8.9 001.002.000255.4 1.2.3 v1.2.3.4x 99999999999.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005 4111  1111 1111 1111 41111111111111111111111",
    "+1 (509) 555-6973 +44.20.7946.0958) +1 +12345 ++1 509 555 6973 +1 509 555 6973 1 2 3 4 5 6 +1--------- ",
    "call (509) 555-6973 or write to anna [at] example [dot] org, ssn 123-45-6789",
    "born on 12.03.1980 in 1987, paid 12.50 EUR on 2021-03-05, version 1.2.3, pp. 12-40",
    "٣٤٥.١.٢.٣ 1.2.3.٤ １２３@４.５ a@ｂ.ｃ",
]


def test_query_equals_brute_force_and_keeps_base_spans(spark, sf_dir, corpus):
    rng = random.Random(11)
    parts = [" ", ".", "@", "+1", "-", "(", ")", "12", "7", "4111", "255", "a", "é", "dot", "at", "\n", "1.2.3.4", "x@y.z", "4111 1111 1111 1111"]
    docs = [*corpus, *((1000 + i, t) for i, t in enumerate(SAID)), *((2000 + i, "".join(rng.choices(parts, k=rng.randrange(40)))) for i in range(250))]
    got = queries.op12_personal_data(spark, sf_dir(docs))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = {r["doc_id"]: r for r in got.collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        want, r = brute(text), got[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        spans = [x for x in r["spans"].split(",") if x]
        assert [x for x in spans if not x.startswith("crf_")] == want
        assert [int(x.split(":")[1]) for x in spans] == sorted(int(x.split(":")[1]) for x in spans)
        assert [r[f"n_{k}"] for k in personal_data.BASE_KINDS] == [sum(x.startswith(k) for x in want) for k in personal_data.BASE_KINDS]


def cuttings(n, cuts, types):
    """Every way to cut ``n`` tokens into outside tokens (None) and typed segments."""
    if n == 0:
        yield []
        return
    for head in cuttings(n - 1, cuts, types):
        yield [*head, None]
    for c, (i, j) in enumerate(cuts):
        if j == n:
            for head, y in itertools.product(list(cuttings(i, cuts, types)), range(types)):
                yield [*head, (c, y)]


def test_sums_best_path_and_posteriors_equal_enumeration():
    rng = np.random.default_rng(3)
    n, cuts, types = 5, [(0, 2), (1, 3), (2, 3), (2, 5), (4, 5)], 2
    scores, follow = rng.normal(size=(len(cuts), types)), rng.normal(size=(types + 1, types + 1))

    def weight(path):
        labels = [0, *(0 if x is None else x[1] + 1 for x in path)]
        return sum(follow[a, b] for a, b in itertools.pairwise(labels)) + sum(scores[x] for x in path if x)

    every = [(weight(p), p) for p in cuttings(n, cuts, types)]
    total, post, pairs = personal_data.forward_backward(n, cuts, scores, follow)
    mass = sum(np.exp(w) for w, _ in every)
    assert total == pytest.approx(np.log(mass))
    assert personal_data.best_path(n, cuts, scores, follow) == [x for x in max(every, key=lambda e: e[0])[1] if x]
    for c, y in itertools.product(range(len(cuts)), range(types)):
        assert post[c, y] == pytest.approx(sum(np.exp(w) for w, p in every if (c, y) in p) / mass)
    labels = [(np.exp(w), [0, *(0 if x is None else x[1] + 1 for x in p)]) for w, p in every]
    want = np.zeros_like(follow)
    for w, said in labels:
        for a, b in itertools.pairwise(said):
            want[a, b] += w / mass
    assert pairs == pytest.approx(want)


def test_held_out_sentences(field):
    right = wrong = missed = 0
    for text, truth in personal_data.sentences(WORDS, 500, seed=77):
        base = personal_data.base_spans(text)
        got = {(k, s, e) for k, s, e, _ in personal_data.model_spans(field, text, base)}
        want = {(f"crf_{truth[2]}", *truth[:2])} if truth and not any(s < truth[1] and e > truth[0] for _, s, e in base) else set()
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) >= 0.95 and right / (right + missed) >= 0.85


def test_what_the_patterns_miss_and_what_is_none(field):
    got = {i: [(k, t[s:e]) for k, s, e, _ in personal_data.scan_text(field, t.encode()) if k.startswith("crf_")] for i, t in enumerate(SAID)}
    assert ("crf_phone", "(509) 555-6973") in got[4] and ("crf_id", "123-45-6789") in got[4]
    assert any(k == "crf_email" for k, _ in got[4])
    assert got[5] == [("crf_birth", "12.03.1980")]
    rng = random.Random(4)
    clean = [prose(rng, 200) for _ in range(30)]
    assert not any(personal_data.scan_text(field, t.encode()) for t in clean)


def test_only_stretches_around_anchors_are_cut_out_and_blocks_change_nothing(field, monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice([*WORDS * 3, "7", "(509) 555-6973", "x@y", "a dot b", "ssn 123-45-6789"]) for _ in range(900))
    whole = [m.span() for m in personal_data.TOKEN.finditer(text)]
    seen = [t for part in personal_data.islands(text) for t in part]
    assert seen == sorted(set(seen)) and set(seen) <= set(whole)
    want = {(whole[i][0], whole[j - 1][1]) for i, j in personal_data.segments(text, whole)}
    assert want == {(p[i][0], p[j - 1][1]) for p in personal_data.islands(text) for i, j in personal_data.segments(text, p)}
    spans = personal_data.scan_text(field, text.encode())
    monkeypatch.setattr(personal_data, "BLOCK", 150)
    assert [x[:3] for x in personal_data.scan_text(field, text.encode())] == [x[:3] for x in spans] and len(spans) > 20


@pytest.mark.parametrize("text", ["x" * 400_000 + "@", "1" * 200_000, "a@" * 3_000, "+1" * 5_000, "1.." * 2_000, "+1" + " " * 200_000, "12 " * 3_000])
def test_long_texts_take_time_near_their_length(field, text):
    t = time.perf_counter()
    assert [f"{k}:{s}:{e}" for k, s, e, _ in personal_data.scan_text(field, text.encode()) if k in personal_data.BASE_KINDS] == []
    assert time.perf_counter() - t < 20


def test_fit_is_repeatable_and_uses_a_bounded_sample(docs):
    rng = random.Random(1)
    frame = docs([(i, " ".join(rng.choices(WORDS, k=50)) + " 7@x dot") for i in range(50)] + [(None, "x"), (7, None)])
    words = personal_data.sample_words(frame.repartition(7), "doc_id", "text", 10)
    assert words == personal_data.sample_words(frame, "doc_id", "text", 10) and set(words) <= set(WORDS)


def test_a_bound_on_the_hash_keeps_the_sample(docs):
    frame = docs([(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}".replace("word", "")) for i in range(3000)])
    few = personal_data.sample_words(frame, "doc_id", "text", 100)  # bounded
    many = personal_data.sample_words(frame, "doc_id", "text", 300)  # not bounded
    assert len(few) == 100 and len(many) == 300 and set(few) <= set(many)


def test_repeated_rows_null_ids_empty_tables(docs, field):
    got = personal_data.find_personal_data(docs([(1, SAID[0]), (1, SAID[0]), (None, SAID[0]), (2, None), (3, "")]), field=field).collect()
    assert sorted((r["id"], len(r["spans"]) > 0) for r in got) == [(1, True), (2, False), (3, False)]
    assert personal_data.find_personal_data(docs([])).collect() == []
