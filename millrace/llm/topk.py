"""Exact top-k search by inner product: a ball tree and branch and bound per shard.

Vectors are dealt into shards of bounded size, queries into blocks.  First every
query is searched in one shard of its own; its k-th score there then bounds the
search in all the other shards.  In a shard, nodes are opened in the order of their
largest possible inner product (centre plus radius), and a node goes unopened for
the queries whose current k-th score it can't reach.

Defined results: components become floor(scale * x); vectors that are null, hold a
null or a component that isn't finite, or have no id take no part; equal rows count
once; vectors of another length than the query's don't meet it; a query with fewer
candidates gets them all; equal scores go to the smaller id; a score beyond 64 bits
is the nearest 64-bit integer.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.sinks import stage

K = 5
SCALE = 256
#: Vectors in a shard and queries in a block: what one task holds.
SHARD_ROWS, BLOCK_ROWS = 100_000, 20_000
LEAF_ROWS = 128
_LOW = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(id, vector, size) of the vectors that take part."""
    cells = F.transform(F.col(embedding), lambda x: x.cast("double"))
    good = F.forall(cells, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & good)
    # A double holds every floor(scale * x) exactly, also beyond 64 bits.
    whole = F.transform(cells, lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0))
    return rows.select(F.col(vec_id).cast("long").alias("id"), whole.alias("vector")).distinct().withColumn("size", F.size("vector"))


class BallTree:
    """Balls over the rows of a matrix; a node is (centre, radius, rows) or has two children."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centers, self.radii, self.rows, self.children = [], [], [], []
        if len(points):
            self._grow(np.arange(len(points)))
            self.center = np.array(self.centers)
            self.radius = np.array(self.radii)

    def _grow(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        center = own.mean(0)
        distance = np.sqrt(((own - center) ** 2).sum(1))
        node = len(self.centers)
        self.centers.append(center)
        self.radii.append(distance.max())
        self.rows.append(rows)
        self.children.append(())
        if len(rows) > LEAF_ROWS and distance.max() > 0:
            # Two far points give the direction; the median along it halves the ball.
            a = own[distance.argmax()]
            b = own[((own - a) ** 2).sum(1).argmax()]
            order = np.argsort(own @ (b - a), kind="stable")
            half = len(rows) // 2
            self.children[node] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return node


def search(tree: BallTree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of each query; only those that reach its bound need be right."""
    n = len(queries)
    scores, found = np.full((n, k), _LOW, np.int64), np.full((n, k), np.iinfo(np.int64).max, np.int64)
    if not len(ids):
        return scores, found
    length = np.sqrt((queries**2).sum(1))
    limit = float(np.abs(tree.points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
    exact = limit < 2**53
    slack = 1e-9 * (1 + limit)
    as_ints = None if exact else (np.array([[int(x) for x in r] for r in tree.points], object), np.array([[int(x) for x in r] for r in queries], object))

    def best(node: int, active: np.ndarray) -> np.ndarray:
        return queries[active] @ tree.center[node] + length[active] * tree.radius[node] + slack

    everyone = np.arange(n)
    heap = [(-np.inf, 0, everyone, best(0, everyone))]
    while heap:
        _, node, active, upper = heapq.heappop(heap)
        least = np.maximum(bound[active], scores[active, -1])
        active = active[upper >= least]
        if not len(active):
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                upper = best(child, active)
                stays = upper >= np.maximum(bound[active], scores[active, -1])
                if stays.any():
                    heapq.heappush(heap, (-upper[stays].max(), child, active[stays], upper[stays]))
            continue
        rows = tree.rows[node]
        for part in np.array_split(rows, max(1, len(rows) // (4 * LEAF_ROWS))):
            if exact:
                got = np.rint(queries[active] @ tree.points[part].T).astype(np.int64)
            else:
                got = np.clip(as_ints[1][active] @ as_ints[0][part].T, _LOW + 1, np.iinfo(np.int64).max).astype(np.int64)
            got[own[active][:, None] == ids[part][None, :]] = _LOW
            reach = (got >= np.maximum(bound[active], scores[active, -1])[:, None]).any(1)
            mine = active[reach]
            if len(mine):
                all_scores = np.concatenate([scores[mine], got[reach]], 1)
                all_ids = np.concatenate([found[mine], np.broadcast_to(ids[part], (len(mine), len(part)))], 1)
                order = np.lexsort((all_ids, -np.maximum(all_scores, _LOW + 1)))[:, :k]
                scores[mine] = np.take_along_axis(all_scores, order, 1)
                found[mine] = np.take_along_axis(all_ids, order, 1)
    return scores, found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    size = len(rows[0]) if len(rows) else 0
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)


def _search(k: int) -> Callable:
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        # A fixed order makes the tree the same if the task runs again.
        vectors, queries = vectors.sort_by("id"), queries.sort_by("q_id")
        names = ["query_id", "query", "vec_id", "score"]
        if not len(vectors) or not len(queries):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64())], names)
        ids, own = vectors["id"].to_numpy(), queries["q_id"].to_numpy()
        bound = queries["bound"].to_numpy()
        scores, found = search(BallTree(_matrix(vectors["vector"])), ids, _matrix(queries["q_vector"]), own, bound, k)
        row, place = np.nonzero((scores > _LOW) & (scores >= bound[:, None]))
        made = [own[row], queries["query"].to_numpy()[row], found[row, place], scores[row, place]]
        return pa.table([pa.array(x) for x in made], names)

    return run


def top_k(
    vectors: DataFrame,
    is_query: str,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row that ``is_query`` picks.

    ``is_query`` is a condition on ``id``, the row's id.
    """
    table = stage(quantized(vectors, vec_id, embedding, scale), "vectors")
    session = table.sparkSession
    cores = session.sparkContext.defaultParallelism
    queries = table.filter(is_query).withColumn("query", F.xxhash64("vector"))
    n, n_queries = table.count(), queries.count()
    shards = max(min(cores, math.ceil(n / (8 * LEAF_ROWS))), math.ceil(n / SHARD_ROWS), 1)
    blocks = max(math.ceil(n_queries / BLOCK_ROWS), 1)
    table = table.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    queries = queries.withColumn("home", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(shards)).cast("int"))
    spread = table.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["size", "shard", "block"]
    schema = "query_id long, query long, vec_id long, score long"

    def round_of(asked: DataFrame) -> DataFrame:
        # Names of its own keep the two sides, which come from one table, apart.
        asked = asked.select("query", "bound", *[F.col(c).alias(f"q_{c}") for c in ("id", "vector", *keys)])
        return spread.groupBy(*keys).cogroup(asked.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(_search(k), schema)

    first = stage(round_of(queries.withColumn("shard", F.col("home")).withColumn("bound", F.lit(int(_LOW)).cast("long"))), "first")
    # A k-th score is known where the home shard had k candidates.
    floor = first.groupBy("query_id", "query").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    floor = floor.select(F.col("query_id").alias("id"), "query", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    others = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    rest = queries.join(floor, ["id", "query"], "left").withColumn("bound", F.coalesce("least", F.lit(int(_LOW)).cast("long")))
    rest = rest.withColumn("shard", others).filter("shard != home")
    every = first.unionByName(round_of(rest))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
