import math

import numpy as np
import pytest

from tollgate.llm import queries, tree_search

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "a", None) for i, v in rows], SCHEMA)


def brute(rows, k=20):
    """{query: [(id, score)]} over all vectors that take part."""
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, q in rows:
        if i % 20 == 0:
            near = sorted((-(q * v).sum(), j) for j, v in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def clustered(n, d, seed=1, spread=0.4, norms=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x * rng.uniform(0.3, 3, n)[:, None] if norms else x


def lists(got):
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, want):
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hit / sum(len(near) for near in want.values())


@pytest.mark.parametrize("norms", [False, True])
def test_query_reaches_the_recall_and_scores_exactly(spark, tmp_path, norms):
    rows = list(enumerate(clustered(4000, 16, norms=norms).tolist()))
    rows += [(5000 + i, rows[40][1]) for i in range(60)]  # equal vectors: ties go to the smaller id
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found, want = lists(queries.op10_tree_search(spark, str(tmp_path)).collect()), brute(rows)
    assert set(found) == set(want) and all(len(x) == 20 for x in found.values())
    assert recall(found, want) >= 0.9
    vec = dict(rows)
    for q, near in found.items():
        for i, s in near:
            assert s == pytest.approx((np.array(vec[q], np.float32).astype(float) * np.array(vec[i], np.float32)).sum(), abs=1e-12)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
    assert [i for i, _ in found[40]] == list(range(5000, 5020))


def test_recall_on_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert recall(lists(queries.op10_tree_search(spark, path).collect()), brute(rows)) >= 0.9


@pytest.mark.parametrize("near", [0, 2, 1000])
def test_all_leaves_and_blocks_give_the_exact_answer(spark, near):
    rows = list(enumerate(clustered(700, 8).tolist()))
    got = tree_search.search(frame(spark, rows), leaf=20, target=1.0, calibration=100, block=7, near=near)
    got = got.withColumnsRenamed({"query": "query_id", "id": "vec_id"}).collect()
    want = brute(rows)
    assert {q: [i for i, _ in x] for q, x in lists(got).items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_what_takes_no_part(spark):
    good = [(0, [1, 0]), (1, [0, 1]), (20, [1, 1]), (7, [-1, 0])]
    odd = [(2, None), (40, [0, 0]), (60, [math.nan, 1]), (80, [math.inf, 1]), (100, [None, 1]), (120, []), (140, [1, 2, 3]), (None, [1, 1]), (1, [0, 1])]
    got = tree_search.search(frame(spark, good + odd)).collect()
    assert sorted((r["query"], r["rank"], r["id"], r["score"]) for r in got) == [
        (0, 1, 20, 1.0), (0, 2, 1, 0.0), (0, 3, 7, -1.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 7, -1.0),
    ]
    assert tree_search.search(frame(spark, odd[:3])).collect() == []
    assert tree_search.search(frame(spark, [])).collect() == []
    assert tree_search.search(frame(spark, [(20, [1, 0])])).collect() == []


def test_best_bins_visit_every_leaf_once_and_the_own_leaf_early():
    x = clustered(2000, 8)
    tree = tree_search.fit(x, 1.0, 30)
    leaf = tree.leaf_of(x)
    places = []
    for i in range(0, 2000, 97):
        order = list(tree.best_bins(x[i]))
        assert sorted(order) == list(range(tree.leaves))
        places.append(order.index(leaf[i]))
    assert np.median(places) == 0 and max(places) < tree.leaves / 4


def in_order(tree, q, visits, sizes, k):
    """The first leaves, one by one from the queue."""
    out, seen = [], 0
    for n, leaf in enumerate(tree.best_bins(q), 1):
        out.append(leaf)
        seen += sizes[leaf]
        if n >= visits and seen > k:
            break
    return out


@pytest.mark.parametrize("grid", [False, True])
def test_first_bins_are_the_first_of_the_queue(grid):
    x = clustered(1500, 6)
    if grid:  # equal distances to many centres
        x = np.stack(np.meshgrid(*[[-2.0, -1.0, 1.0, 2.0]] * 4), -1).reshape(-1, 4)
        x /= np.linalg.norm(x, axis=1)[:, None]
    tree = tree_search.fit(x, 1.0, 10)
    sizes = np.bincount(tree.leaf_of(x), minlength=tree.leaves)
    sizes[::7] = 0
    q = x[::23]
    for visits in (1, 2, 3, 10, 37, tree.leaves // 2, tree.leaves, tree.leaves + 5):
        for k, near in ((0, 3), (20, 8), (300, 0), (10**6, 10**6)):
            out, first = tree.first_bins(q, visits, sizes, k, near)
            for i, v in enumerate(q):
                want = in_order(tree, v, visits, sizes, k)
                assert set(np.flatnonzero(out[i])) == set(want)
                held = [leaf for leaf in want if sizes[leaf]]
                assert first[i].sum() == min(near, len(held)) and not (first[i] & ~out[i]).any() and sizes[first[i]].all()
    one = tree_search.fit(x[:3], 1.0, 10)
    assert [a.tolist() for a in one.first_bins(q[:2], 5, np.array([3]), 2, 8)] == [[[True], [True]]] * 2


@pytest.mark.parametrize("wide", [False, True])
def test_rounds_and_many_equal_vectors_give_the_exact_answer(spark, wide):
    rows = list(enumerate(clustered(300, 8).tolist()))
    rows += [(1000 + i, rows[40 if i % 3 else 7][1]) for i in range(300)]  # more than k equal vectors, queries among them
    data = frame(spark, rows)
    if wide:
        rows = [(i, (1e150 * np.array(v)).tolist()) for i, v in rows]
        data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = tree_search.search(data, leaf=20, target=1.0, calibration=100, near=2, asked=4, block=50).collect()
    want = brute(rows) if not wide else {}
    if wide:  # doubles that no float holds
        vec = {i: np.array(v) for i, v in rows}
        want = {q: sorted(((i, (vec[i] * vec[q]).sum()) for i in vec if i != q), key=lambda r: (-r[1], r[0]))[:20] for q in vec if q % 20 == 0}
    found = {}
    for r in sorted(got, key=lambda r: (r["query"], r["rank"])):
        found.setdefault(r["query"], []).append(r["id"])
    assert found == {q: [i for i, _ in near] for q, near in want.items()}


def test_nearest_forgets_what_is_too_far_and_keeps_ties_of_smaller_ids():
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (400, 3)).astype(float)  # many equal scores
    ids, q_at = rng.permutation(1000)[:400], np.sort(rng.permutation(400)[:50])
    q_at = q_at[np.argsort(ids[q_at])]
    found = tree_search.Nearest(ids[q_at], x[q_at], np.full(50, -np.inf), 5, 16)
    found.room = 100
    for rows in np.array_split(rng.permutation(400), 9):
        found.compare(np.arange(50), ids[rows], x[rows])
        found.room = 100
    at, got, score = found.best()
    for n, i in enumerate(q_at):
        want = sorted((-(x[i] * x[j]).sum(), ids[j]) for j in range(400) if j != i)[:5]
        assert [(-s, j) for s, j in zip(score[at == n], got[at == n], strict=True)] == want


def test_no_row_for_each_query_and_leaf(spark, monkeypatch):
    """What is written grows with vectors, and with queries times k, however many leaves a query visits."""
    counts, saved = [], tree_search.saved

    def counted(*args):
        out = saved(*args)
        counts.append(out.count())
        return out

    monkeypatch.setattr(tree_search, "saved", counted)
    rows = list(enumerate(clustered(1200, 16, spread=3).tolist()))
    got = tree_search.search(frame(spark, rows), k=2, leaf=4, target=1.0)
    assert got.count() == 60 * 2
    assert max(counts) <= 1200, counts  # 60 queries visit more than 20 leaves each
