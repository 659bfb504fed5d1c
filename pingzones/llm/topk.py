"""Exact top-k inner products: a ball tree per shard, searched by branch and bound.

Candidates are dealt into shards of bounded size and each shard gets a ball
tree.  Queries come in blocks; a block visits a tree's nodes in the order of
their upper bound, centre times query plus radius times length of the query,
and leaves out those below the queries' kth score.  Shards are searched in
waves of doubling size; what a wave found is the kth score the next starts with.
"""

from __future__ import annotations

import heapq
import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import stored

SHARD_ROWS = 8192
BLOCK_ROWS = 256
LEAF_ROWS = 128
# Products of whole numbers are exact as doubles below this.
EXACT = 2.0**53
LONG = 2**63
# From here on a double has no fraction.
LARGE = 2.0**53


def quantised(vectors: DataFrame, scale: float, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) of every component, as doubles.

    Null vectors and those with a null or non-finite component are left out.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # floor() itself returns a long, which large components would overflow.
    scaled = F.transform(
        x, lambda c: F.when(F.abs(c * scale) < LARGE, F.floor(c * scale).cast("double")).otherwise(c * scale)
    )
    return vectors.filter(F.col(vector).isNotNull() & ~bad).select(
        F.col(id_).alias("vec_id"), F.size(x).alias("dim"), scaled.alias("v")
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, held to the range of a long."""
    if a.shape[1] and a.size and b.size:
        most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
        if not most < EXACT:
            whole = np.vectorize(int, otypes=[object])
            return np.clip(whole(a) @ whole(b).T, -LONG, LONG - 1).astype(np.int64)
    return (a @ b.T).astype(np.int64)


class BallTree:
    """Nodes (centre, radius, first row, end row, children) over reordered rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.order, self.nodes = np.arange(len(rows)), []
        self._grow(rows, 0, len(rows))
        self.ids, self.rows = ids[self.order], rows[self.order]

    def _grow(self, rows: np.ndarray, first: int, end: int) -> int:
        at = len(self.nodes)
        own = rows[self.order[first:end]]
        centre = own.mean(axis=0)
        apart = np.sqrt(((own - centre) ** 2).sum(axis=1))
        self.nodes.append(None)
        children = ()
        if end - first > LEAF_ROWS and apart.max() > 0:
            # Split at the middle between two far rows, halfway in number.
            a = own[apart.argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            self.order[first:end] = self.order[first:end][np.argsort(own @ (b - a), kind="stable")]
            middle = (first + end) // 2
            children = (self._grow(rows, first, middle), self._grow(rows, middle, end))
        self.nodes[at] = (centre, float(apart.max()), first, end, children)
        return at

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> list[pd.DataFrame]:
        """The up to k best (query, vec_id, score) of each query with a score of ``floor`` or more."""
        n, lengths = len(ids), np.sqrt((queries**2).sum(axis=1))
        kth = floor.astype(np.float64)
        best_scores = [np.empty(0, np.int64)] * n
        best_ids = [np.empty(0, np.int64)] * n

        def bounds(node: int, active: np.ndarray) -> np.ndarray:
            centre, radius = self.nodes[node][:2]
            bound = queries[active] @ centre + radius * lengths[active]
            return bound + 1e-9 * (np.abs(bound) + radius * lengths[active] + 1)  # rounding never prunes

        everyone, ticket = np.arange(n), itertools.count()
        bound = bounds(0, everyone)
        waiting = [(-bound.max(), next(ticket), 0, everyone, bound)]
        while waiting:
            _, _, node, active, bound = heapq.heappop(waiting)
            open_ = bound >= kth[active]
            active = active[open_]
            if not active.size:
                continue
            _, _, first, end, children = self.nodes[node]
            for child in children:
                bound = bounds(child, active)
                heapq.heappush(waiting, (-bound.max(), next(ticket), child, active, bound))
            if children:
                continue
            scores = products(queries[active], self.rows[first:end])
            for i, row in zip(active.tolist(), scores):
                good = (row >= kth[i]) & (self.ids[first:end] != ids[i])
                if not good.any():
                    continue
                s = np.concatenate([best_scores[i], row[good]])
                v = np.concatenate([best_ids[i], self.ids[first:end][good]])
                top = np.lexsort((v, ~s))[:k]  # ~s falls as s rises, and never overflows
                best_scores[i], best_ids[i] = s[top], v[top]
                if len(top) == k:
                    kth[i] = max(kth[i], float(s[top[-1]]))
        return [
            pd.DataFrame({"query_id": ids[i], "vec_id": best_ids[i], "score": best_scores[i]})
            for i in range(n) if len(best_ids[i])
        ]


FOUND = "query_id long, vec_id long, score long"


def _stack(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), dim)


def _each(first: int, end: int) -> Column:
    """A row for each number from ``first`` to before ``end``."""
    return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long")))


def _search_pair(k: int):
    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(shard) and len(block):
            dim = int(shard["dim"].iloc[0])
            tree = BallTree(shard["vec_id"].to_numpy(np.int64), _stack(shard["v"], dim))
            parts = tree.search(
                block["vec_id"].to_numpy(np.int64), _stack(block["v"], dim), block["floor"].to_numpy(np.float64), k
            )
        columns = ["query_id", "vec_id", "score"]
        return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype=np.int64) for c in columns})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of ``vectors`` for each query.

    Both have (vec_id, dim, v) with whole numbers in ``v``.  Score: inner product
    of vectors of equal length, held to the range of a long; ties go to the
    smaller id; a row is no result of its own id.  Rows without an id take no
    part.  Repeated rows of one id are candidates each, and their queries are
    answered once for the first of them by content.  Empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.filter("vec_id is not null"), "topk-vectors")
    asked = queries.filter("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q"))
    asked = stored(asked.select("vec_id", "q.dim", "q.v"), "topk-queries")
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / BLOCK_ROWS))
    # The id spreads repeated vectors; equal rows of one id are few.
    dealt = stored(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))), "topk-shards")
    in_blocks = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    all_blocks = _each(0, blocks).alias("block")
    best, first, width = spark.createDataFrame([], FOUND), 0, 1
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while first < shards:
        end = min(first + width, shards)
        kth = best.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")
        )
        floor = F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf"))).alias("floor")
        with_floor = in_blocks.join(kth, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "dim", "v", "block", floor)
        of_wave = dealt.filter(F.col("shard").between(first, end - 1)).select("*", all_blocks)
        of_shard = _each(first, end).alias("shard")
        left, right = of_wave.groupBy("shard", "block", "dim"), with_floor.select("*", of_shard).groupBy("shard", "block", "dim")
        found = left.cogroup(right).applyInPandas(_search_pair(k), FOUND)
        ranked = best.unionByName(found).withColumn("rank", F.row_number().over(of_query))
        best = stored(ranked.filter(F.col("rank") <= k).drop("rank"), "topk-best")
        first, width = end, 2 * width
    return best.select("query_id", F.row_number().over(of_query).alias("rank"), "vec_id", "score")
