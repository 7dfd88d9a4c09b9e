"""Nearest neighbours by inner product over a graph built by NN-descent.

Equal vectors are one node. Nodes fall into shards of bounded size; the graph of each shard grows
out of random neighbours: round after round, Spark joins the neighbours of every node with their
neighbours (either direction), and the best of what is met are kept. Inner products are turned
into a metric for that by one more component, which lengthens all vectors to the longest. A query
searches the graph of every shard greedily, in blocks of queries, and the best of all shards are
ranked by exact inner products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, settle

#: nodes in a shard, at most about so many; a task holds one shard
SHARD_NODES = 8192
#: queries that search a shard in one task
BLOCK_QUERIES = 4096
#: neighbours kept of each node, and of those that have it as a neighbour
DEGREE = 16
ROUNDS = 5
#: candidates that a search holds, and nodes that it begins with
BREADTH = 192
ENTRIES = 64


def _similar(vectors: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.empty(len(left), dtype=np.float32)
    for at in range(0, len(left), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", vectors[left[part]], vectors[right[part]])
    return out


def improve(
    vectors: np.ndarray, near: np.ndarray, close: np.ndarray, source: np.ndarray, found: np.ndarray, degree: int
) -> tuple[np.ndarray, np.ndarray]:
    """Best ``degree`` of each node's neighbours so far (near, close: -1 and -inf where there are
    fewer) and of the candidates ``found`` for ``source``."""
    n = len(vectors)
    pairs = np.unique(source.astype(np.int64) * n + found)
    source, found = pairs // n, pairs % n
    fresh = source != found
    source, found = source[fresh], found[fresh]
    similar = _similar(vectors, source, found)
    better = similar > close[source, -1]
    source, found, similar = source[better], found[better], similar[better]
    rows = np.concatenate([np.repeat(np.arange(n), degree), source])
    ids = np.concatenate([near.ravel(), found])
    values = np.concatenate([close.ravel(), similar])
    known = ids >= 0
    rows, ids, values = rows[known], ids[known], values[known]
    _, first = np.unique(rows * n + ids, return_index=True)
    rows, ids, values = rows[first], ids[first], values[first]
    order = np.lexsort((ids, -values, rows))
    rows, ids, values = rows[order], ids[order], values[order]
    starts = np.searchsorted(rows, np.arange(n))
    place = np.arange(len(rows)) - starts[rows]
    keep = place < degree
    near = np.full((n, degree), -1, dtype=np.int64)
    close = np.full((n, degree), -np.inf, dtype=np.float32)
    near[rows[keep], place[keep]] = ids[keep]
    close[rows[keep], place[keep]] = values[keep]
    return near, close


def links_of(near: np.ndarray, back: int) -> np.ndarray:
    """Neighbours of each node in either direction, padded with -1."""
    n, degree = near.shape
    source, target = np.repeat(np.arange(n), degree), near.ravel()
    known = target >= 0
    source, target = source[known], target[known]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, np.arange(n))[target]
    out = np.full((n, degree + back), -1, dtype=np.int64)
    out[:, :degree] = near
    keep = place < back
    out[target[keep], degree + place[keep]] = source[keep]
    return out


def greedy(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, k: int, breadth: int, step: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for each query: the ``step`` best nodes that are not yet opened are opened,
    their links join the ``breadth`` best, until none of these is unopened."""
    n, q = len(vectors), len(queries)
    breadth = min(max(breadth, k), n)
    begin = np.unique(np.linspace(0, n - 1, min(n, max(ENTRIES, breadth))).astype(np.int64))
    values = queries @ vectors[begin].T
    order = np.argsort(-values, axis=1, kind="stable")[:, :breadth]
    ids = np.full((q, breadth), -1, dtype=np.int64)
    best = np.full((q, breadth), -np.inf, dtype=np.float32)
    ids[:, : order.shape[1]] = begin[order]
    best[:, : order.shape[1]] = np.take_along_axis(values, order, 1)
    opened = ids < 0
    seen = np.zeros((q, n), dtype=bool)
    seen[:, begin] = True
    rows = np.arange(q)
    while len(rows):
        waiting = np.where(opened[rows], -np.inf, best[rows])
        chosen = np.argsort(-waiting, axis=1, kind="stable")[:, :step]
        live = np.isfinite(np.take_along_axis(waiting, chosen, 1))
        some = live.any(axis=1)
        rows, chosen, live = rows[some], chosen[some], live[some]
        if not len(rows):
            break
        at, slot = np.nonzero(live)
        owner, node = rows[at], ids[rows[at], chosen[at, slot]]
        opened[owner, chosen[at, slot]] = True
        reached = links[node]
        pairs = np.unique(np.where(reached >= 0, owner[:, None] * n + reached, -1))
        pairs = pairs[pairs >= 0]
        pairs = pairs[~seen.reshape(-1)[pairs]]
        seen.reshape(-1)[pairs] = True
        owner, node = pairs // n, pairs % n
        value = np.einsum("ij,ij->i", queries[owner], vectors[node])
        useful = value > best[owner, -1]
        owner, node, value = owner[useful], node[useful], value[useful]
        touched = np.unique(owner)
        if not len(touched):
            continue
        place = np.arange(len(owner)) - np.searchsorted(owner, touched)[np.searchsorted(touched, owner)]
        row = np.searchsorted(touched, owner)
        wide = int(place.max()) + 1
        more_ids = np.full((len(touched), wide), -1, dtype=np.int64)
        more = np.full((len(touched), wide), -np.inf, dtype=np.float32)
        more_ids[row, place], more[row, place] = node, value
        all_values = np.concatenate([best[touched], more], axis=1)
        order = np.argsort(-all_values, axis=1, kind="stable")[:, :breadth]
        best[touched] = np.take_along_axis(all_values, order, 1)
        ids[touched] = np.take_along_axis(np.concatenate([ids[touched], more_ids], axis=1), order, 1)
        closed = np.concatenate([opened[touched], more_ids < 0], axis=1)
        opened[touched] = np.take_along_axis(closed, order, 1)
    return ids[:, :k], best[:, :k]


def _matrix(column: pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    values = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return values.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lengthened(exact: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", exact, exact), 0))
    return np.column_stack([exact, rest]).astype(np.float32)


def _ordered(table: pa.Table, by: str = "at") -> pa.Table:
    return table.sort_by(by)


def _graph_columns(table: pa.Table, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """The graph of a shard whose rows are in order: neighbours and similarities, padded."""
    n = table.num_rows
    near = np.full((n, degree), -1, dtype=np.int64)
    close = np.full((n, degree), -np.inf, dtype=np.float32)
    sizes = table["near"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n), sizes)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    near[rows, place] = pa.concat_arrays([c.flatten() for c in table["near"].chunks]).to_numpy(zero_copy_only=False)
    close[rows, place] = pa.concat_arrays([c.flatten() for c in table["close"].chunks]).to_numpy(zero_copy_only=False)
    return near, close


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once: with an id, and a vector that is
    neither null, empty nor zero and whose components are all finite numbers."""
    kept = vectors.select(col(vec_id).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    return kept.filter("vec_id is not null and vector is not null").filter(
        fine & F.exists("vector", lambda x: x != 0.0)
    ).distinct()


def _nodes(rows: DataFrame, shard_nodes: int) -> DataFrame:
    """(width, shard, at, node, vector, shard_size): distinct vectors numbered within their shard.

    A node is known by the smallest vec_id that has its vector.
    """
    distinct = rows.groupBy("vector").agg(F.min("vec_id").alias("node")).withColumn("width", F.size("vector"))
    sizes = {r[0]: r[1] for r in rows.groupBy(F.size("vector")).count().collect()}  # one number a vector length
    shards = F.lit(1)
    for width, n in sizes.items():
        shards = F.when(F.col("width") == width, F.lit(math.ceil(n / shard_nodes))).otherwise(shards)
    within = Window.partitionBy("width", "shard")
    return (
        distinct.withColumn("shard", F.pmod(F.xxhash64("node"), shards).cast("int"))
        .withColumn("at", F.row_number().over(within.orderBy(F.xxhash64("node", F.lit(1)), "node")) - 1)
        .withColumn("shard_size", F.count("*").over(within).cast("int"))
    )


def build_graph(
    nodes: DataFrame, longest: float, degree: int = DEGREE, rounds: int = ROUNDS
) -> DataFrame:
    """(width, shard, at, near, close): neighbours of each node within its shard, the best first."""
    key = ["width", "shard"]
    # each node begins with random ones
    hops = nodes.select(
        *key,
        F.col("at").alias("source"),
        F.transform(
            F.sequence(F.lit(1), F.lit(degree)),
            lambda i: F.pmod(F.xxhash64("node", i), F.col("shard_size")).cast("int"),
        ).alias("found"),
    )
    graph = nodes.select(
        *key, "at", F.array().cast("array<int>").alias("near"), F.array().cast("array<float>").alias("close")
    )
    schema = "width int, shard int, at int, near array<int>, close array<float>"

    def merged(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _ordered(right)
        width, shard = right["width"][0].as_py(), right["shard"][0].as_py()
        vectors = _lengthened(_matrix(right["vector"], width), longest)
        near, close = _graph_columns(right, degree)
        for at in range(0, left.num_rows, 1 << 15):  # candidates of some rows at a time
            some = left.slice(at, 1 << 15)
            lists = some["found"].combine_chunks()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            source = np.repeat(some["source"].to_numpy(), sizes)
            near, close = improve(vectors, near, close, source, lists.flatten().to_numpy(zero_copy_only=False), degree)
        known = near >= 0
        offsets = np.concatenate([[0], np.cumsum(known.sum(axis=1))]).astype(np.int32)
        n = len(near)
        return pa.table(
            {
                "width": pa.array(np.full(n, width), pa.int32()),
                "shard": pa.array(np.full(n, shard), pa.int32()),
                "at": pa.array(np.arange(n), pa.int32()),
                "near": pa.ListArray.from_arrays(pa.array(offsets), pa.array(near[known], pa.int32())),
                "close": pa.ListArray.from_arrays(pa.array(offsets), pa.array(close[known], pa.float32())),
            }
        )

    for turn in range(rounds + 1):
        held = nodes.select(*key, "at", "vector").join(graph, [*key, "at"])
        graph = settle(
            hops.toDF(*hops.columns).groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(merged, schema), f"graph-{turn}"
        )
        if turn == rounds:
            break
        forward = graph.select(*key, "at", F.explode("near").alias("other"))
        # those that have a node as a neighbour: a shard's nodes at most, of which some are taken
        backward = (
            forward.groupBy(*key, F.col("other").alias("at"))
            .agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("at", F.lit(turn)).alias("order"), F.col("at").alias("from")))).alias("back"))
            .select(*key, "at", F.slice("back.from", 1, degree).alias("back"))
        )
        links = settle(
            graph.join(backward, [*key, "at"], "left").select(
                *key, "at", F.array_union("near", F.coalesce("back", F.array().cast("array<int>"))).alias("links")
            ),
            f"links-{turn}",
        )
        # neighbours of neighbours
        hops = (
            links.select(*key, F.col("at").alias("source"), F.explode("links").alias("at"))
            .join(links, [*key, "at"])
            .select(*key, "source", F.col("links").alias("found"))
        )
    return graph


def search(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    shard_nodes: int = SHARD_NODES,
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    breadth: int = BREADTH,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found nearest to each query row, itself left out.

    ``is_query`` is a condition on column ``vec_id``. Scores are inner products in double
    precision; ties go to the smaller vec_id. A row that repeats an id and its vector counts
    once; vectors of different lengths do not meet. Queries without a usable vector, and an
    empty table, give no rows.
    """
    rows = settle(usable(vectors, vec_id, vector), "vectors")
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
    nodes = settle(_nodes(rows, shard_nodes), "nodes")
    graph = build_graph(nodes, longest, degree, rounds)
    key = ["width", "shard"]

    asked = rows.filter(is_query).withColumn("width", F.size("vector"))
    number = asked.count()
    blocks = max(1, math.ceil(number / BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.join(nodes.select(*key).distinct(), "width")  # every shard hears every query
    held = (
        nodes.select(*key, "at", "node", "vector")
        .join(graph, [*key, "at"])
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    schema = "query_id long, node long, score double"

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        right = _ordered(right)
        width = right["width"][0].as_py()
        exact, wanted = _matrix(right["vector"], width), _matrix(left["vector"], width)
        names, asking = right["node"].to_numpy(), left["vec_id"].to_numpy()
        plain = _lengthened(exact, longest)
        near, _ = _graph_columns(right, degree)
        ways = links_of(near, degree)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(wanted), 256):
            some = wanted[at : at + 256]
            level = np.column_stack([some, np.zeros(len(some))]).astype(np.float32)
            ids, _ = greedy(plain, ways, level, k + 1, breadth)
            row, place = np.nonzero(ids >= 0)
            node = ids[row, place]
            score = np.einsum("ij,ij->i", some[row], exact[node])
            out.append((asking[at : at + 256][row], names[node], score))
        joined = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(("query_id", "node", "score"), joined)))

    group = [*key, "block"]
    found = asked.toDF(*asked.columns).groupBy(*group).cogroup(held.groupBy(*group)).applyInArrow(searched, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")
    # rows of a node: no more of them than can be among the nearest
    first = Window.partitionBy("vector").orderBy("vec_id")
    members = (
        rows.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= k + 1)
        .join(nodes.select("vector", "node"), "vector")
        .select("node", "vec_id")
    )
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.join(members, "node")
        .filter("vec_id != query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
