import hashlib
import random

from tollgate.llm import decontaminate, queries

from test_licenses import plain_words


def brute(rows, items, window=13):
    """{doc: (n_words, n_hit, n_items, items_sha256, contaminated)} by looking for every window everywhere."""
    wins = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = {}
    for doc, text in rows:
        w = plain_words(text)
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in wins:
                    hit.update(range(i, i + size))
                    found |= wins[key]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def planted(corpus):
    """Documents and items: windows cut at either end, repeats, short items, twins, odd texts."""
    rng = random.Random(5)
    said = [t for _, t in corpus if t and 40 < len(t.split()) < 130]
    items = [(100 + i, " ".join(t.split()[i : i + 30])) for i, t in enumerate(said[:12])]
    items += [(200, "a"), (201, "naïve"), (202, ""), (203, None), (9, items[0][1]), (205, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (206, said[20].upper())]
    docs = list(corpus)
    for i in range(30):
        w = items[i % 12][1].split()
        a, b = sorted(rng.sample(range(len(w) + 1), 2))
        docs.append((5000 + i, " ".join(["zz"] * rng.randrange(3) + w[a:b] + ["yy"] * rng.randrange(60) + w[:14] * (i % 3))))
    docs += [(6000, "w1 " * 40), (6001, "w1, W1! " * 7 + "w2 " + "w1 " * 13), (6002, " ".join(x for _, t in items if t for x in t.split()))]
    return docs, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_query_equals_brute_force(spark, sf_dir, corpus):
    docs, items = planted(corpus)
    got = queries.op8_decontamination(spark, sf_dir(docs, benchmark=bench(spark, items))).collect()
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute(docs, items)
    assert sum(v[1] > 0 for v in want.values()) > 30
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in got} == want
    assert len(got) == len(docs)


def test_proximity_needs_two_rare_terms_close_by(spark, docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    loose = item.replace("gamma", "gamma and")
    far = item.replace(" ", " and so on and on ")
    rows = [(1, item), (2, loose), (3, far), (4, "alpha"), (5, "and so on")]
    got = {r["id"]: (r["n_items"], r["n_near"]) for r in decontaminate.contamination(docs(rows), bench(spark, [(1, item)])).collect()}
    assert got[1] == (1, 1) and got[2][1] == 1 and got[4] == (0, 0) and got[5] == (0, 0)


def test_repeated_rows_null_ids_and_empty_tables(spark, docs):
    item = " ".join(f"t{i}" for i in range(20))
    rows = [(1, item), (1, item), (None, item), (2, None)]
    got = decontaminate.contamination(docs(rows), bench(spark, [(7, item), (7, item), (None, item)])).collect()
    assert sorted((r["id"], r["n_hit"], r["n_items"]) for r in got) == [(1, 20, 1), (2, 0, 0)]
    assert [r["contaminated"] for r in decontaminate.contamination(docs([(1, item)]), bench(spark, [])).collect()] == [False]
    assert decontaminate.contamination(docs([]), bench(spark, [(7, item)])).collect() == []
    kept = decontaminate.keep_clean(docs(rows), bench(spark, [(7, item)]))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2]
