"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Vectors are dealt to shards of a bounded size by a hash of their id. A task builds the graph of
a shard: distinct vectors, each linked to near and mutually diverse ones on its layers. The
graph is stored as flat arrays, one row per shard: vectors, ids, and for each layer an array of
neighbours with a fixed number of places per node. Queries come in blocks; a task searches one
shard for one block, and the shards' nearest are merged by distance.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .tables import table, written
from .words import mix

SHARD = 2048
QUERY_BLOCK = 256
LINKS = 16
BUILD_WIDTH = 96
SEARCH_WIDTH = 192
NEAREST = 10
QUERIES = 100
INDEX = (
    "shard int, dim int, n long, vectors binary, ids binary, id_begins binary, entry long, "
    "layers array<binary>"
)
FOUND = "query_id long, vec_id long, score double"


class Graph:
    """The graph of one shard, in flat arrays. Layer 0 has ``2 * LINKS`` places a node."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int) -> None:
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self.norms = (vectors * vectors).sum(axis=1)

    def distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared Euclidean distances, up to the query's own norm."""
        return self.norms[nodes] - 2 * (self.vectors[nodes] @ query)

    def nearest(self, query: np.ndarray, layer: int, start: list[int], width: int) -> list[tuple]:
        """The ``width`` nearest nodes that a best-first walk of one layer finds, nearest first."""
        links = self.layers[layer]
        seen = set(start)
        at = self.distances(query, np.array(start))
        open_ = [(float(d), n) for d, n in zip(at, start, strict=True)]
        heapq.heapify(open_)
        best = [(-d, n) for d, n in open_]
        heapq.heapify(best)
        while open_:
            d, node = heapq.heappop(open_)
            if len(best) >= width and d > -best[0][0]:
                break
            row = links[node]
            new = [n for n in row[row >= 0].tolist() if n not in seen]
            if not new:
                continue
            seen.update(new)
            for e, n in zip(self.distances(query, np.array(new)).tolist(), new, strict=True):
                if len(best) < width:
                    heapq.heappush(best, (-e, n))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, n))
                else:
                    continue
                heapq.heappush(open_, (e, n))
        return sorted((-d, n) for d, n in best)

    def search(self, query: np.ndarray, width: int) -> list[tuple]:
        start = [self.entry]
        for layer in range(len(self.layers) - 1, 0, -1):
            start = [self.nearest(query, layer, start, 1)[0][1]]
        return self.nearest(query, 0, start, width)

    def diverse(self, found: list[tuple], most: int) -> list[int]:
        """Of nodes sorted by distance, those nearer to the base than to any taken before, then
        the nearest others as far as there are places."""
        nodes = np.array([n for _, n in found])
        own = self.vectors[nodes]
        between = self.norms[nodes][:, None] + self.norms[nodes][None, :] - 2 * (own @ own.T)
        base = np.array([d for d, _ in found])
        taken: list[int] = []
        closest = np.full(len(nodes), np.inf)
        for k in range(len(nodes)):
            if base[k] < closest[k]:
                taken.append(k)
                if len(taken) == most:
                    break
                closest = np.minimum(closest, between[k])
        if len(taken) < most:
            rest = [k for k in range(len(nodes)) if k not in set(taken)]
            taken += rest[: most - len(taken)]
        return nodes[taken].tolist()


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    """Inserts the vectors one after another; levels follow a hash of the place, so reruns agree."""
    n = len(vectors)
    draws = mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)).astype(np.float64) / 2.0**64
    levels = np.minimum((-np.log(np.maximum(draws, 1e-18)) / math.log(LINKS)).astype(int), 12)
    places = [2 * LINKS if k == 0 else LINKS for k in range(int(levels.max()) + 1)]
    graph = Graph(vectors, [np.full((n, m), -1, dtype=np.int32) for m in places], 0)
    top = int(levels[0])
    for node in range(1, n):
        query, start = vectors[node], [graph.entry]
        own = float(graph.norms[node])
        for layer in range(top, int(levels[node]), -1):
            start = [graph.nearest(query, layer, start, 1)[0][1]]
        for layer in range(min(top, int(levels[node])), -1, -1):
            found = graph.nearest(query, layer, start, BUILD_WIDTH)
            start = [x for _, x in found]
            links, most = graph.layers[layer], places[layer]
            # Distances now with the base's norm, as they are compared with those between nodes.
            chosen = graph.diverse([(d + own, x) for d, x in found], LINKS)
            links[node, : len(chosen)] = chosen
            for other in chosen:
                row = links[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                    continue
                around = np.append(row, node)
                at = graph.distances(vectors[other], around) + graph.norms[other]
                order = np.argsort(at, kind="stable")
                row[:] = graph.diverse([(float(at[k]), int(around[k])) for k in order], most)
        if levels[node] > top:
            top, graph.entry = int(levels[node]), node
    return graph


def _index(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("vec_id")
    every = np.array(group["embedding"].tolist(), dtype=np.float64)
    vectors, owner = np.unique(every, axis=0, return_inverse=True)
    order = np.argsort(owner.ravel(), kind="stable")  # ids of one vector stay ascending
    begins = np.append(0, np.cumsum(np.bincount(owner.ravel(), minlength=len(vectors))))
    # Vectors sorted by value are inserted in a fixed shuffled order, or the graph gets lopsided.
    shuffled = np.argsort(mix(np.arange(1, len(vectors) + 1, dtype=np.uint64)))
    ids = group["vec_id"].to_numpy()[order]
    ids = np.concatenate([ids[begins[k] : begins[k + 1]] for k in shuffled])
    begins = np.append(0, np.cumsum(np.diff(begins)[shuffled]))
    graph = build(vectors[shuffled].astype(np.float32))
    return pd.DataFrame(
        {
            "shard": [int(group["shard"].iloc[0])],
            "dim": [every.shape[1]],
            "n": [len(vectors)],
            "vectors": [vectors[shuffled].tobytes()],
            "ids": [ids.astype(np.int64).tobytes()],
            "id_begins": [begins.astype(np.int64).tobytes()],
            "entry": [graph.entry],
            "layers": [[x.tobytes() for x in graph.layers]],
        }
    )


def _search(index: pd.DataFrame, queries: pd.DataFrame, nearest: int, width: int) -> pd.DataFrame:
    out: list[tuple[int, int, float]] = []
    for row in index.itertuples(index=False):
        vectors = np.frombuffer(row.vectors).reshape(row.n, row.dim)
        ids = np.frombuffer(row.ids, dtype=np.int64)
        begins = np.frombuffer(row.id_begins, dtype=np.int64)
        layers = [np.frombuffer(x, dtype=np.int32).reshape(row.n, -1) for x in row.layers]
        graph = Graph(vectors.astype(np.float32), layers, int(row.entry))
        for query in queries.itertuples(index=False):
            wanted = np.array(query.embedding, dtype=np.float64)
            if len(wanted) != row.dim:
                continue
            found = graph.search(wanted.astype(np.float32), width)
            nodes = np.array([n for _, n in found])
            # The distance proper, on the original vectors; sums run in the order of components.
            exact = np.sqrt(np.add.accumulate((vectors[nodes] - wanted) ** 2, axis=1)[:, -1])
            rows: list[tuple[float, int]] = []
            for k in np.lexsort((nodes, exact)):
                if len(rows) > nearest and exact[k] > rows[nearest][0]:
                    break
                own = ids[begins[nodes[k]] : begins[nodes[k] + 1]]
                rows += [(float(exact[k]), int(x)) for x in own[: nearest + 1]]
            rows = sorted(x for x in rows if x[1] != query.vec_id)[:nearest]
            out += [(query.vec_id, vec_id, d) for d, vec_id in rows]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def usable(embedding: Column) -> Column:
    """Vectors with components that are all known and finite and not all zero."""
    known = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return embedding.isNotNull() & known & F.exists(embedding, lambda x: x != 0)


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """Usable vectors by vec_id. Of rows that repeat a vec_id the least vector stands for it."""
    return (
        embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    )


def build_index(vectors: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """The graphs of all shards as a written table, one row each."""
    count = vectors.count()
    shards = max(1, -(-count // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # Vectors of another length cannot be compared, so they make shards of their own.
    keyed = dealt.withColumn("dim", F.size("embedding"))
    return written(
        keyed.groupBy("shard", "dim").applyInPandas(lambda group: _index(group), INDEX), "hnsw"
    )


def search(
    index: DataFrame, queries: DataFrame, nearest: int = NEAREST, width: int = SEARCH_WIDTH
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of the nearest found for rows (vec_id, embedding)."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    number = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    shards = index.select("shard").distinct()
    dealt = queries.withColumn("block", number)
    # Every block meets every shard: both sides list the other's numbers, which are few.
    n_shards = shards.agg(F.max("shard")).first()[0]
    if n_shards is None:
        return queries.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards))))
    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(lambda a, b: _search(a, b, nearest, width), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose vec_id is divisible by 100, among all others.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows
    without vec_id. Of rows that repeat a vec_id the least vector stands for it. Vectors of
    another length than the query's are no candidates. An empty table gives no rows.
    """
    vectors = written(vectors_of(table(spark, sf_dir, "embeddings")), "vectors")
    return search(build_index(vectors), vectors.filter(F.col("vec_id") % QUERIES == 0))


#: The exact answer. On the test tables the graphs find all of it; in general they may miss some.
SQL = """
WITH known AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM known q JOIN known c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""
