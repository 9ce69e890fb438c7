import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import types as T
from samples import prose

from tollgate.llm import periodic_runs, queries


def brute_runs(w):
    """Every run by its definition: for each period the longest stretches that keep it."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q) and (s, i + q) not in found:  # a smaller period has been there before
                found[s, i + q] = q
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]


def brute(i, text):
    words = planted(i, re.findall("[^\x20\x09-\x0d]+", text or ""))
    runs = brute_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, kept)]
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        letters, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.randrange(rng.choice([12, 40, 150]))
        w = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.choice([3, 4, 5, 6, 10])
            w = [*w[:a], *(w[a + (i - a) % p] for i in range(a, n)), *w[a : a + rng.randrange(5)]]
        if rng.random() < 0.2:
            w += w[::-1] + w * rng.randrange(3)
        said = [b"%d" % x for x in w]
        got = periodic_runs.runs_of_texts([said, said[::-1], said])
        assert got[0] == got[2] == brute_runs(w), w
        assert got[1] == brute_runs(w[::-1]), w
        if w:
            assert periodic_runs.runs_of(w, [(0, n := len(w))]) == brute_runs(w), w


def test_grammar_derives_the_words_and_leaves_no_pair_twice():
    rng = random.Random(4)
    words = [rng.randrange(6) for _ in range(300)] + [7, 8, 9] * 40
    g, rows = periodic_runs.re_pair(words, [(0, 300), (300, len(words))])

    def derive(x):
        return [x] if x >= 0 else [w for kid in g.kids[-x - 1] for w in derive(kid)]

    assert [w for row in rows for x, _ in row for w in derive(x)] == words
    for k in range(len(g.kids)):
        assert derive(-k - 1) == words[g.at[k] : g.at[k] + g.size[k]]
    pairs = [(a[0], b[0]) for row in rows for a, b in zip(row, row[1:], strict=False)]
    twice = {p for p in pairs if pairs.count(p) > 1}
    assert all(a == b for a, b in twice)  # only pairs that overlap each other may stay
    assert max(len(row) for row in rows[1:]) < 12


@pytest.mark.parametrize("words", [[1] * 30_000, [0, 1] * 15_000, [*range(5_000)] * 5, [i % 3 for i in range(10_000)] + [*range(9)] * 900])
def test_long_texts(words):
    got = periodic_runs.runs_of_texts([[b"%d" % x for x in words]])[0]
    assert got and sum(n for _, n, _ in got) >= len(words)


def test_query_equals_brute_force(spark, sf_dir, corpus):
    rng = random.Random(6)
    rows = [*corpus, *((2000 + i, prose(rng, rng.randrange(200), 30)) for i in range(150))]
    rows += [(3000, "la " * 700), (3001, "a b c " * 90 + "d " + "x\ty\n" * 9), (3002, " ".join(["one two"] * 3)), (3003, "é ü " * 4)]
    rows += [(4000 + i, "to be or " * rng.randrange(1, 9) + prose(rng, 9)) for i in range(40)]
    got = queries.op11_runs(spark, sf_dir(rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    got = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert got == {i: brute(i, text) for i, text in rows}
    assert sum(x[0] for x in got.values()) > 40


def test_collapsed_text_repeated_rows_null_ids_and_clashing_names(spark, docs):
    rows = [(1, "x a b a b a b a b y"), (1, "x a b a b a b a b y"), (1, "zz"), (None, "a"), (2, None), (3, " \t")]
    got = {r["id"]: r for r in periodic_runs.find_runs(docs(rows)).collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1]["collapsed"] == "x a b y" and [tuple(x) for x in got[1]["runs"]] == [(1, 8, 2)]
    assert got[2]["collapsed"] == got[3]["collapsed"] == "" and got[2]["runs"] == [] and got[2]["n_words"] == 0
    clash = spark.createDataFrame([(5, "b " * 9, 1, "w")], "doc_id long, text string, runs int, words string")
    assert periodic_runs.find_runs(clash).first()["collapsed"] == "b"
    assert queries.periodic_tails(clash.withColumn("h", clash["runs"]).withColumn("id", clash["runs"])).count() == 1


def test_empty_table_and_bad_bounds(docs):
    assert periodic_runs.find_runs(docs([])).collect() == []
    assert isinstance(periodic_runs.find_runs(docs([])).schema["runs"].dataType, T.ArrayType)
    with pytest.raises(ValueError, match="periods"):
        periodic_runs.find_runs(docs([]), powers=2)
