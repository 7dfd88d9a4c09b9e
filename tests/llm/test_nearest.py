"""NN-descent and greedy search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from lakeloom.llm import nn_descent
from lakeloom.llm.queries import QUERIES
from tests.conftest import SF


def brute(pairs, queries, k):
    """{query: [(vec_id, score), ...]} over all rows."""
    ids = np.array([i for i, _ in pairs])
    vectors = np.array([v for _, v in pairs], dtype=float)
    out = {}
    for q in queries:
        scores = vectors @ vectors[np.flatnonzero(ids == q)[0]]
        order = [o for o in np.lexsort((ids, -scores)) if ids[o] != q][:k]
        out[q] = [(int(ids[o]), scores[o]) for o in order]
    return out


def found_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(found, truth):
    assert found.keys() == truth.keys()
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in t}) / len(t) for q, t in truth.items()])


def frame(spark, pairs):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0.5) for i, v in pairs],
        "vec_id long, embedding array<double>, rank int, score double",
    )


def test_recall_of_the_query(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    pairs = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    truth = brute(pairs, [i for i, _ in pairs if i % 20 == 0], 20)
    found = found_of(QUERIES["op4_nn_descent"](spark, sf))
    assert recall(found, truth) > 0.95
    exact = dict(pairs)
    for q, nearest in found.items():
        assert len(nearest) == 20
        for i, score in nearest:
            assert abs(score - np.dot(np.array(exact[q], float), np.array(exact[i], float))) < 1e-12


def test_recall_over_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK_QUERIES", 40)
    rng = np.random.default_rng(2)
    points = rng.normal(size=(900, 12)) * rng.uniform(0.2, 3, size=(900, 1))  # lengths differ
    pairs = list(enumerate(points.tolist()))
    found = found_of(nn_descent.search(frame(spark, pairs), F.col("vec_id") % 9 == 0, k=10, shard_nodes=300, breadth=100))
    assert recall(found, brute(pairs, range(0, 900, 9), 10)) > 0.9


def test_graph_is_near_the_true_one():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 8)).astype(np.float32)
    n, degree = len(points), 10
    near, close = np.full((n, degree), -1), np.full((n, degree), -np.inf, dtype=np.float32)
    near, close = nn_descent.improve(points, near, close, np.repeat(np.arange(n), degree), rng.integers(0, n, n * degree), degree)
    for _ in range(6):
        links = nn_descent.links_of(near, degree)
        source = np.repeat(np.arange(n), links.shape[1])
        known = links.ravel() >= 0
        reached = links[links.ravel()[known]]
        source = np.repeat(source[known], links.shape[1])
        good = reached.ravel() >= 0
        near, close = nn_descent.improve(points, near, close, source[good], reached.ravel()[good], degree)
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    truth = np.argsort(-scores, axis=1)[:, :degree]
    assert np.mean([len(set(a) & set(b)) / degree for a, b in zip(near, truth)]) > 0.9
    assert np.all(np.diff(close, axis=1) <= 0)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    one, two = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    pairs = [(i, one) for i in range(10, 60)] + [(0, one), (0, one), (20, two), (70, two), (80, [2.0, 2.0, 0.0])]
    odd = [(40_000, None), (1, [0.0, 0.0, 0.0]), (3, [1.0, None, 0.0]), (5, [1.0, float("nan"), 0.0]),
           (7, [float("inf"), 0.0, 0.0]), (None, one), (9, []), (100, [3.0, 4.0])]
    found = found_of(nn_descent.search(frame(spark, pairs + odd).repartition(3), F.col("vec_id") % 20 == 0, k=5))
    assert found.keys() == {0, 20, 40, 80}
    assert found[0] == [(80, 2.0), (10, 1.25), (11, 1.25), (12, 1.25), (13, 1.25)]
    assert found[40] == [(80, 2.0), (0, 1.25), (10, 1.25), (11, 1.25), (12, 1.25)]
    assert found[80][:5] == [(0, 2.0), (10, 2.0), (11, 2.0), (12, 2.0), (13, 2.0)]


def test_few_rows_and_none(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0])])
    found = found_of(nn_descent.search(df, F.col("vec_id") % 20 == 0))
    assert found == {0: [(1, 4.0), (20, 3.0)], 20: [(0, 3.0), (1, 3.0)]}
    assert nn_descent.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nn_descent.search(df.limit(1), F.col("vec_id") % 20 == 0).count() == 0
