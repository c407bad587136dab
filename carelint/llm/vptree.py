"""Operator 6: nearest neighbours by vantage-point trees, one for each shard.

Vectors are put on the unit sphere, where distance falls as cosine rises.  Each shard is a tree: a
node holds a vantage point and the median distance r to it; nearer points are on one side,
farther ones on the other.  A query at distance d of the vantage point, whose k-th best found so
far is at distance t, needs the other side only if |d - r| <= factor * t.  By the triangle
inequality factor 1 loses nothing; smaller factors prune more.

Queries are searched in blocks against every shard; of each shard only its k best leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelint.llm.vectors import by_key, dots, matrix, norms, usable

#: Neighbours; pruning factor; vectors of a shard; queries of a block; points of a leaf.
K, FACTOR, SHARD_ROWS, QUERY_ROWS, LEAF = 5, 1.0, 4096, 1024, 64


class Tree:
    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.ids, self.raw, self.norm = ids, x, norms(x)
        self.x = x / self.norm[:, None]
        self.leaf = leaf
        self.root = self._build(np.arange(len(x)))

    def _build(self, own: np.ndarray):
        if len(own) <= self.leaf:
            return own
        v = own[0]
        d = np.sqrt(np.maximum(0, 2 - 2 * (self.x[own[1:]] @ self.x[v])))
        r = float(np.median(d))
        inside = d <= r
        if inside.all():  # at most points as far as the median: halves of it are as good
            inside[len(inside) // 2 :] = False
        return v, r, self._build(own[1:][inside]), self._build(own[1:][~inside])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int = K, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines [query, rank], best first and ties by id; -1 and -inf where there are fewer."""
        self.q_ids, self.q_raw, self.q_norm, self.k, self.factor = query_ids, queries, norms(queries), k, factor
        self.q = queries / self.q_norm[:, None]
        self.best = np.full((len(queries), k), -np.inf)
        self.who = np.full((len(queries), k), -1, np.int64)
        self._visit(self.root, np.arange(len(queries)))
        return self.who, self.best

    def _visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self._offer(active, node)
            return
        v, r, near, far = node
        self._offer(active, np.array([v]))
        d = np.sqrt(np.maximum(0, 2 - 2 * (self.q[active] @ self.x[v])))
        inner = d <= r
        self._visit(near, active[inner])
        self._visit(far, active[~inner])
        # Distances of this size carry rounding errors up to about 1e-7.
        reach = self.factor * np.sqrt(np.maximum(0, 2 - 2 * np.maximum(self.best[active, -1], -1))) + 1e-6
        other = np.abs(d - r) <= reach
        self._visit(far, active[inner & other])
        self._visit(near, active[~inner & other])

    def _offer(self, active: np.ndarray, points: np.ndarray) -> None:
        rough = self.q[active] @ self.x[points].T
        i, j = np.nonzero((rough >= self.best[active, -1:] - 1e-9) & (self.q_ids[active][:, None] != self.ids[points][None, :]))
        if not len(i):
            return
        rows, pts = active[i], points[j]
        score = dots(self.q_raw[rows], self.raw[pts]) / (self.q_norm[rows] * self.norm[pts])
        touched = np.unique(rows)
        row = np.concatenate([rows, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.best[touched].ravel()])
        who = np.concatenate([self.ids[pts], self.who[touched].ravel()])
        o = np.lexsort((who, -score, row))
        row, score, who = row[o], score[o], who[o]
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        take = starts[:, None] + np.arange(self.k)
        self.best[touched], self.who[touched] = score[take], who[take]


def nearest(queries: DataFrame, vectors: DataFrame, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest rows of ``vectors`` but itself.

    Both have vec_id and embedding; only these are read.  Rows take part if vec_id is not null and
    the vector is not null, empty or zero and all components are finite; only equal dimensions
    meet.  Ties go to the smaller vec_id.  Rows that repeat a vec_id count once, with their greatest vector.
    """
    def clean(df: DataFrame) -> DataFrame:
        fine = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(usable() & F.col("vec_id").isNotNull())
        return fine.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))

    q, x = clean(queries), clean(vectors)
    shards, blocks = max(1, -(-x.count() // shard_rows)), max(1, -(-q.count() // query_rows))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    points = x.select("vec_id", "embedding", F.size("embedding").alias("dim"), own(shards).alias("shard"), F.lit(-1).alias("block"))
    asked = q.select("vec_id", "embedding", F.size("embedding").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), own(blocks).alias("block"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, home = None, None
        for (shard, dim, block), g in by_key(batches, ["shard", "dim", "block"]):
            if block < 0:  # a shard's vectors come before the queries
                tree, home = Tree(g["vec_id"].to_numpy(), matrix(g["embedding"])), (shard, dim)
            elif home == (shard, dim):
                ids = g["vec_id"].to_numpy()
                who, score = tree.search(ids, matrix(g["embedding"]), k, factor)
                out = pd.DataFrame({"query_id": np.repeat(ids, k), "vec_id": who.ravel(), "score": score.ravel()})
                yield out[np.isfinite(out["score"])]

    fields = ("shard", "dim", "block", "vec_id", "embedding")
    met = points.select(*fields).union(asked.select(*fields)).repartition("shard", "dim").sortWithinPartitions("shard", "dim", "block")
    found = met.mapInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6(vectors: DataFrame) -> DataFrame:
    return nearest(vectors.where(F.col("vec_id") % 50 == 0), vectors)
