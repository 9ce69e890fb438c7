import hashlib
import random
import re

import pytest

from samples import prose
from tollgate.llm import automaton_dedup, queries


def brute(rows, length=13):
    """{doc: (n_words, n_removed, kept_sha256)} from a set of the windows of all smaller ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        wins = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
        gone = [False] * len(words)
        for i, w in enumerate(wins):
            if w in seen:
                gone[i : i + length] = [True] * length
        seen.update(wins)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(got, want):
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got}
    assert got == want


def tricky():
    rng = random.Random(8)
    base = [prose(rng, 60, 5000).split() for _ in range(6)]
    rows = [" ".join(prose(rng, 4).split() + base[0][5 : 5 + n] + prose(rng, 4).split()) for n in (11, 12, 13, 14, 15, 25, 26, 27, 40)]
    for _ in range(40):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice(["x", "Y", "é"])
        a = rng.randrange(30)
        rows.append("\t ".join(t[a : a + rng.randrange(10, 50)]))
    rows += ["a " * 12, "a " * 13, "a " * 14, "a " * 50, "a b " * 20, "a b c " * 20, " ".join(base[1] * 3), " ".join(base[2] + ["é"] * 20 + base[2])]
    rows += [" ".join(b) for b in base] + [" ".join(base[3])] * 4
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_query_equals_brute_force(spark, sf_dir, corpus):
    rows = [*corpus, *((1000 + i, t) for i, t in tricky())]
    got = queries.op9_substrings(spark, sf_dir(rows)).withColumnRenamed("doc_id", "id").collect()
    want = brute(rows)
    assert sum(x[1] > 0 for x in want.values()) > 40
    check(got, want)


@pytest.mark.parametrize(("length", "gram", "crowd"), [(13, 5, 5000), (13, 5, 2), (4, 2, 5000), (4, 2, 3), (3, 3, 0)])
def test_other_lengths_crowds_and_small_batches(spark, docs, length, gram, crowd):
    rng = random.Random(length + crowd)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randrange(0, 40)))) for i in range(120)] + [(200 + i, "a b " * rng.randrange(60)) for i in range(10)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = automaton_dedup.remove_passages(docs(rows).repartition(3), length, gram, crowd).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    check(got, brute(rows, length))
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_automaton_matching_statistics():
    rng = random.Random(1)
    for _ in range(200):
        a = automaton_dedup.SuffixAutomaton()
        known = [rng.choices(range(3), k=rng.randrange(12)) for _ in range(rng.randrange(5))]
        for k in known:
            a.add(k)
        parts = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        said = rng.choices(range(4), k=20)
        want = [max([n for n in range(1, e + 2) if tuple(said[e + 1 - n : e + 1]) in parts], default=0) for e in range(20)]
        assert a.matches(said) == want


def test_repeated_rows_null_ids_and_empty_tables(docs):
    t = " ".join(f"w{i}" for i in range(20))
    got = automaton_dedup.remove_passages(docs([(1, t), (1, t), (None, t), (2, None), (3, t)])).collect()
    check(got, brute([(1, t), (2, None), (3, t)]))
    assert automaton_dedup.remove_passages(docs([])).collect() == []


#: Texts of one window with the same anchor, whose spans agree in 32 of 64 bits.
ALIKE = ("uu qu gu zo pi fe wi yu qa uo ke uu lo", "eu la fe io pi fe wi yu qa ro xa me yi")


def test_spans_that_agree_in_half_their_bits_are_no_copies(docs):
    rows = list(enumerate([*ALIKE, ALIKE[0]]))
    got = automaton_dedup.remove_passages(docs(rows)).collect()
    assert {r["id"]: r["n_removed"] for r in got} == {0: 0, 1: 0, 2: 13}
    check(got, brute(rows))
