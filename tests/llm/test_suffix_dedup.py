import hashlib
import random

import pytest

from samples import prose
from tollgate.llm import queries, suffix_dedup


def brute(rows, length=100):
    """{doc: (n_bytes, n_removed, n_spans, kept_sha256)} from a set of all windows so far."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(raw[i : i + length])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(got, want):
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = {r["id"]: tuple(r[c] for c in cols) for r in got}
    assert got == want


def tricky():
    """Copies of every length about the threshold, overlaps, periods, repeats inside a text, edits."""
    rng = random.Random(8)
    base = [prose(rng, 60, 5000) for _ in range(6)]
    rows = []
    for n in (98, 99, 100, 101, 102, 140, 199, 200, 201):
        rows.append(prose(rng, 10, 5000) + base[0][7 : 7 + n] + prose(rng, 10, 5000))
    for _ in range(25):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("xyzé")
        a = rng.randrange(60)
        rows.append("".join(t[a : a + rng.randrange(100, 400)]))
    rows += ["a" * 99, "a" * 100, "a" * 101, "a" * 350, "ab" * 160, "abc" * 120 + base[1], base[1] * 3, base[2] + "é" * 80 + base[2], ("é" * 70 + "😀" * 40) * 2]
    rows += base + [base[3]] * 4
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_query_equals_brute_force(spark, sf_dir, corpus):
    rows = [*corpus, *((1000 + i, t) for i, t in tricky())]
    got = queries.op6_suffix_array(spark, sf_dir(rows)).withColumnRenamed("doc_id", "id").collect()
    want = brute(rows)
    assert sum(x[1] > 0 for x in want.values()) > 40
    check(got, want)


@pytest.mark.parametrize(("length", "gram"), [(100, 40), (9, 4), (5, 5)])
def test_other_lengths_small_alphabets_and_small_batches(spark, docs, length, gram):
    rng = random.Random(length)
    rows = [(i, "".join(rng.choices("ab", k=rng.randrange(0, 60)))) for i in range(120)] + [(200 + i, "ab" * rng.randrange(120)) for i in range(10)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = suffix_dedup.remove_repeats(docs(rows).repartition(3), length, gram).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    check(got, brute(rows, length))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_repeated_rows_null_ids_and_empty_tables(docs):
    t = "z" * 60 + "y" * 60
    got = suffix_dedup.remove_repeats(docs([(1, t), (1, t), (None, t), (2, None), (3, t)])).collect()
    check(got, brute([(1, t), (2, None), (3, t)]))
    assert suffix_dedup.remove_repeats(docs([])).collect() == []


#: Texts of one window with the same anchor, whose spans agree in 32 of 64 bits.
ALIKE = (
    "ggssfzswijuvcdvftdexgqhnqytfxjuramsadxueszeixtmtxheommhueowdbpzqrgnphnrliressqymktbbrjtgkqrrzvbpmvwd",
    "nytxxdbvvofmxbivxzqyheglmwagovuramsadxueszeixtmtxheommhueowdbpzqrgnphnaxzxcabtdptfpkatnbyrflsbwmtbhu",
)


def test_spans_that_agree_in_half_their_bits_are_no_copies(docs):
    rows = list(enumerate([*ALIKE, ALIKE[0]]))
    got = suffix_dedup.remove_repeats(docs(rows)).collect()
    assert {r["id"]: r["n_removed"] for r in got} == {0: 0, 1: 0, 2: 100}
    check(got, brute(rows))
