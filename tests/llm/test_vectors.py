"""Vector near-duplicates and exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import common, cover_tree, multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def table(spark, vectors, labels, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], labels[i], "x")
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def crowd(n=300, dim=16, seed=3):
    """Clusters of near copies of different spread, equal rows, and rows that take no part."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    vecs = [base[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.01, 0.08, 0.15]) for _ in range(n)]
    vecs = [np.float32(v) for v in vecs]
    vecs[10], vecs[11] = vecs[9], vecs[9] * 2
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [None] * dim, [float("inf")] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0]]
    labels = [int(x) for x in rng.integers(0, 3, n)] + [0] * len(odd)
    labels[9] = labels[10] = labels[11] = 1
    labels[20] = None
    return vecs + odd, labels


def brute_links(vecs, labels, threshold=0.98):
    ok = [i for i, v in enumerate(vecs) if labels[i] is not None and v is not None and len(v) and all(x is not None for x in v)
          and np.isfinite(v).all() and np.any(np.asarray(v, float) != 0)]
    links = {i: set() for i in range(len(vecs))}
    for i in ok:
        for j in ok:
            if i != j and labels[i] == labels[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.asarray(vecs[i], float), np.asarray(vecs[j], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
    comp = {}
    for i in links:
        if i not in comp:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = i
                    todo += links[x]
    return {i: (len(links[i]), comp[i], comp[i] == i) for i in links}


@pytest.mark.parametrize("rows_in_block", [7, 1024])
def test_near_duplicates(spark, rows_in_block):
    vecs, labels = crowd()
    out = multi_index.near_duplicates(table(spark, vecs, labels), rows_in_block=rows_in_block, rows_in_cell=8)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()} == brute_links(vecs, labels)


def test_near_duplicates_of_nothing(spark):
    assert multi_index.near_duplicates(table(spark, [], [])).count() == 0
    r = multi_index.near_duplicates(table(spark, [None], [1])).first()
    assert (r.n_links, r.component_id, r.kept) == (0, 0, True)


def test_walk_is_in_order_and_whole():
    rng = np.random.default_rng(5)
    sample = rng.normal(size=(400, 8))
    grid = multi_index.Grid(sample, 8, 0.9, 1.0)
    _, gaps = grid.gaps(sample[:20] / np.linalg.norm(sample[:20], axis=1, keepdims=True))
    for a, b in zip(*gaps, strict=True):
        sums = (a[:, None] + b[None]).ravel()
        cells = grid.walk(a, b)
        assert sorted(cells) == np.flatnonzero(sums <= grid.bound).tolist()
        assert (np.diff(sums[cells]) >= 0).all()


def test_lower_target_visits_less():
    sample = np.random.default_rng(5).normal(size=(500, 16))
    assert multi_index.Grid(sample, 8, 0.9, 0.9).bound < multi_index.Grid(sample, 8, 0.9, 1.0).bound


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (101, 102), (7, 7), (200, 300), (300, 250)]
    stages = common.Stages(spark, "t")
    got = {r.node: r.component for r in common.components(spark.createDataFrame(chain, "a long, b long"), stages).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100, 250: 200, 300: 200}
    assert common.components(spark.createDataFrame([], "a long, b long"), stages).count() == 0


@pytest.mark.parametrize("sizes", [(2048, 16384, 2048), (20, 30, 3)])
def test_top_k(spark, sizes):
    vecs, labels = crowd(250)
    vecs[50:60] = [vecs[50]] * 10  # ties
    out = cover_tree.top_k(table(spark, vecs, labels), F.col("vec_id") % 10 == 0, k=7, rows_in_ball=sizes[0], rows_in_block=sizes[1], queries_in_block=sizes[2])
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ok = {i: np.floor(np.asarray(v, float) * 1024).astype(int) for i, v in enumerate(vecs)
          if v is not None and len(v) and all(x is not None for x in v) and np.isfinite(v).all()}
    want = {}
    for q in ok:
        if q % 10 == 0:
            scores = sorted((-int(ok[q] @ ok[x]), x) for x in ok if x != q and len(ok[x]) == len(ok[q]))
            if scores:
                want[q] = [(x, -s) for s, x in scores[:7]]
    assert got == want


def test_top_k_of_nothing(spark):
    assert cover_tree.top_k(table(spark, [], []), F.col("vec_id") % 10 == 0).count() == 0
    assert cover_tree.top_k(table(spark, [[1.0]], [1], [3]), F.col("vec_id") % 10 == 0).count() == 0


def spots(n=4000, dim=64, seed=8):
    rng = np.random.default_rng(seed)
    return np.floor(1024 * (rng.normal(size=(40, dim)) * 3)[rng.integers(0, 40, n)] + 1024 * 0.1 * rng.normal(size=(n, dim)))


def test_a_tree_covers():
    x = spots(600, 4)
    todo, seen = [cover_tree.cover_tree(x, 100, leaf=8)], 0
    assert len(todo[0].all) == len(x) and todo[0].children
    while todo:
        node = todo.pop()
        assert np.sqrt(((x[node.all] - x[node.centre]) ** 2).sum(axis=1)).max() <= node.radius + 1e-6
        if node.children:
            assert sorted(i for c in node.children for i in c.all) == sorted(node.all)
            seen += 1
            todo += node.children
    assert seen > 5


def test_pairs_of_nodes_are_dropped():
    x = spots()
    out, taken = cover_tree.best_of_block(x[:200], np.arange(200), x, np.arange(len(x)), 10)
    assert taken < 0.2 * 200 * len(x)
    scores = x[:200] @ x.T
    scores[np.arange(200), np.arange(200)] = -np.inf
    want = -np.sort(-scores, axis=1)[:, :10]
    assert (out["score"].to_numpy().reshape(200, 10) == want).all()


def test_balls_out_of_reach_are_not_searched(spark, monkeypatch):
    x = spots(1500, 8, 3)
    met = spark.sparkContext.accumulator(0)
    real = cover_tree.best_of_block

    def counted(queries, q_id, rows, *rest):
        met.add(len(queries) * len(rows))
        return real(queries, q_id, rows, *rest)

    monkeypatch.setattr(cover_tree, "best_of_block", counted)
    docs = spark.createDataFrame([(i, (v / 1024).tolist(), 0, "") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int, extra string")
    got = {}
    for r in cover_tree.top_k(docs, F.col("vec_id") % 10 == 0, rows_in_ball=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 1500, 10):
        assert got[q] == sorted(set(range(1500)) - {q}, key=lambda i: (-(x[q] @ x[i]), i))[:10]
    assert 0 < met.value < 0.5 * 150 * 1500


def test_few_queries_share_their_copies_of_the_rows(spark, monkeypatch):
    x = np.floor(1024 * np.random.default_rng(11).normal(size=(1200, 32)))  # evenly spread: nothing can be dropped
    copied = spark.sparkContext.accumulator(0)
    real = cover_tree.best_of_block

    def counted(queries, q_id, rows, *rest):
        copied.add(len(rows))
        return real(queries, q_id, rows, *rest)

    monkeypatch.setattr(cover_tree, "best_of_block", counted)
    docs = spark.createDataFrame([(i, (v / 1024).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cover_tree.top_k(docs, F.col("vec_id") % 10 == 0, rows_in_ball=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 1200, 10):
        assert got[q] == sorted(set(range(1200)) - {q}, key=lambda i: (-(x[q] @ x[i]), i))[:10]
    # one team for all 120 queries: the rows once in the ball where queries begin, and once elsewhere
    assert 0 < copied.value <= 2 * 1200
