import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from samples import prose

from tollgate.llm import importance, queries


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def brute(docs, target):
    """Rows by the contract's own words."""
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for x in grams(text)[1]:
                counts[bucket(x)] += 1
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in range(10_000)]
    rows, able = {}, []
    for i, text in docs:
        words, features = grams(text)
        weight = sum(gain[bucket(x)] for x in features)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[i] = [len(features), weight, score, None]
        if len(words) >= 20:
            able.append((-score, i))
    for rank, (_, i) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        rows[i][3] = rank
    return rows


@pytest.fixture
def rows(corpus):
    rng = random.Random(8)
    return [*corpus, *((1000 + i, prose(rng, rng.randrange(60), 90).upper()) for i in range(300)), (2000, "A-b_c\x7fd{e}f [g]ÀÉ ß1２"), (2001, "x" * 40_000 + " " + "y z " * 9_000)]


def test_query_equals_brute_force(spark, sf_dir, rows):
    rng = random.Random(9)
    target = [prose(rng, 40, 40) for _ in range(12)] + [None, "", "one"]
    bench = spark.createDataFrame([(f"i{i % 5}", x) for i, x in enumerate(target)], "item_id string, text string")
    got = queries.op13_importance(spark, sf_dir(rows, benchmark=bench))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    got = {r[0]: list(r)[1:] for r in got.collect()}
    want = brute(rows, target)
    assert got == want
    assert sum(x[3] is not None for x in want.values()) > 10


def test_matches_overlap_and_end_at_words():
    n, found = importance.buckets_of("Ab, c--D  é".encode(), importance.scanner(3), 10_000)
    assert n == 4
    assert found.tolist() == [bucket(x) for x in ["ab", "c", "d", "é", "ab c", "c d", "d é", "ab c d", "c d é"]]
    assert importance.buckets_of(b" -- ", importance.scanner(3), 10_000)[1].tolist() == []
    assert importance.buckets_of(b"A b", importance.scanner(3), 10_000)[1].tolist() == [bucket(x) for x in ["a", "b", "a b"]]


def test_ranks_over_many_partitions_are_the_whole_order(spark):
    frame = spark.range(5000).repartition(40).selectExpr("id", "id % 7 as score")
    got = importance.numbered(frame, ["score", "id"], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in got] == [*range(1, 5001)]
    assert [r["id"] for r in got] == sorted(range(5000), key=lambda i: (i % 7, i))
    assert importance.numbered(frame.where("id < 0"), ["score", "id"], "rank").collect() == []


def test_draw_keeps_rows_columns_and_clashing_names(spark, docs):
    rng = random.Random(10)
    frame = docs([(i, prose(rng, 30, 50) if i % 20 else "deep sea " * 12) for i in range(200)] + [(None, "deep sea " * 12)]).withColumnRenamed("source", "rank").withColumnRenamed("n_chars", "_drawn_id")
    target = docs([(0, "deep sea " * 2000)])
    got = importance.draw(frame, target)
    assert got.columns == frame.columns and got.dtypes == frame.dtypes
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == 10 and all(i % 20 == 0 for i in ids)


def test_empty_tables_repeated_rows_and_null_ids(docs):
    assert importance.resample(docs([]), docs([])).collect() == []
    got = importance.resample(docs([(1, "a b"), (1, "a b"), (None, "c"), (2, None)]), docs([])).collect()
    assert sorted((r["id"], r["n_features"], r["rank"]) for r in got) == [(1, 3, None), (2, 0, None)]
    assert next(r["weight"] for r in got if r["id"] == 2) == 0
    with pytest.raises(ValueError, match="16 bits"):
        importance.features(docs([]), buckets=1 << 17)


def test_gains_are_floored_log_ratios(spark):
    counts = [spark.createDataFrame(x, "bucket long, n long") for x in ([(0, 5), (2, 1)], [(1, 3)])]
    got = {r["bucket"]: r["gain"] for r in importance.gains(*counts, buckets=4).collect()}
    s, t = np.array([5, 0, 1, 0]), np.array([0, 3, 0, 0])
    assert got == {b: math.floor(1000 * math.log((t[b] + 1) * 10 / ((s[b] + 1) * 7))) for b in range(4)}
