import random

import numpy as np
import xxhash

from tollgate.llm import queries, simhash


def brute_fingerprint(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w.encode() for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(table)).split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """{id: (fingerprint, component)} by comparing every pair."""
    fp = {i: brute_fingerprint(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for x in ids:
        for y in ids:
            if x < y and (fp[x] ^ fp[y]).bit_count() <= 3:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def test_query_equals_brute_force(spark, sf_dir, corpus):
    got = queries.op5_simhash(spark, sf_dir(corpus)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == brute(corpus)
    assert len(got) == len(corpus)


def test_repeated_rows_null_ids_and_empty_tables(spark, docs):
    got = simhash.simhash_groups(docs([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, None), (3, "")])).collect()
    assert sorted((r["id"], r["component"]) for r in got) == [(1, 1), (2, 2), (3, 2)]
    assert simhash.simhash_groups(docs([])).collect() == []


def chained(rng, n, steps):
    """Fingerprints in chains whose neighbours are at most three bits apart."""
    out = []
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(steps):
            out.append(x)
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
    return sorted(set(out))


def test_links_find_every_pair_also_in_split_anchors(spark):
    rng = random.Random(3)
    fps = chained(rng, 40, 12)
    fps += [fps[0] ^ (1 << a) for a in range(64)]
    fps = np.array(sorted(set(fps)), np.uint64)
    frame = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, rep long")
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    lab = np.arange(len(fps))
    while True:
        new = np.array([lab[row].min() for row in near])
        if (new == lab).all():
            break
        lab = new
    want = {i: int(x) for i, x in enumerate(lab)}
    for block in (20_000, 3):
        roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, block=block)).collect()}
        assert {i: roots.get(i, i) for i in want} == want


def test_keep_one_keeps_columns_and_the_smallest_id(docs):
    kept = simhash.keep_one(docs([(5, "p q r s t"), (4, "p q r s t"), (9, "other words stand here now"), (None, "p q r s t")]))
    assert kept.columns == docs([]).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 9]
