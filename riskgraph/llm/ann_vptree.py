"""Approximate nearest neighbours by inner product: a vantage-point tree per
shard, pruned by the triangle inequality, relaxed by a factor.

Largest inner product becomes smallest distance by one more component: with M
the largest norm of a shard, x gets sqrt(M^2 - |x|^2) and a query gets 0, so
|q - x|^2 = M^2 + |q|^2 - 2 q.x. A tree node has a vantage point and halves its
points at the median distance. A query goes down the half on its own side
first; the other half is left out if its distance from the query is, by the
triangle inequality, above the kth distance so far divided by ``factor``.
``factor`` 1 never leaves out a neighbour; above 1 it visits less. All queries
of a block go through a node together.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite
component take no part; every row is indexed, also rows that repeat a vec_id; a
repeated vec_id asks once (its smallest vector) and never finds rows of its own
vec_id; ties go to the smaller vec_id; equal vectors score equal; vectors of
another length are no candidates; an empty table gives an empty result; extra
columns are ignored. A vec_id of null takes no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.shards import BLOCK_ROWS, SHARD_ROWS, TopK, dealt, finite, matrix, ordered_dot, ranked, search

LEAF = 128
FACTOR = 1.1


class VPTree:
    """Nodes in arrays; a leaf is a run ``order[a:z]`` of rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.norm2 = x, np.einsum("ij,ij->i", x, x)
        self.top2 = float(self.norm2.max(initial=0.0))
        self.lift = np.sqrt(np.maximum(self.top2 - self.norm2, 0.0))
        self.root = self._build(np.arange(len(x)), leaf)

    def _from(self, v: int, rows: np.ndarray) -> np.ndarray:
        d2 = (self.norm2[rows] + self.norm2[v] - 2.0 * (self.x[rows] @ self.x[v]) + (self.lift[rows] - self.lift[v]) ** 2)
        return np.sqrt(np.maximum(d2, 0.0))

    def _build(self, rows: np.ndarray, leaf: int):
        if len(rows) <= leaf:
            return rows
        v = int(rows[0])                # rows are dealt by hash, so this is a random one
        d = self._from(v, rows)
        if d.max() - d.min() < 1e-9:    # copies: no distance parts them
            return rows
        inside = d <= np.median(d)
        if inside.all():
            inside = d < d.max()
        near, far = rows[inside], rows[~inside]
        return (v, float(d[inside].min()), float(d[inside].max()), float(d[~inside].min()), float(d[~inside].max()),
                self._build(near, leaf), self._build(far, leaf))

    def search(self, queries: np.ndarray, ids: np.ndarray, best: TopK, factor: float) -> None:
        """Fills ``best`` for all rows of ``queries``."""
        q2 = np.einsum("ij,ij->i", queries, queries)
        scale = np.sqrt(self.top2 + q2)
        slack = 1e-9 * (np.sqrt(self.top2 * q2) + 1e-300)

        def apart(q: np.ndarray, v: int) -> np.ndarray:
            d2 = self.norm2[v] + q2[q] - 2.0 * (queries[q] @ self.x[v]) + self.lift[v] ** 2
            return np.sqrt(np.maximum(d2, 0.0))

        def reach(q: np.ndarray) -> np.ndarray:
            """Distance of the kth neighbour so far."""
            kth = best.kth(q)
            d2 = np.where(np.isfinite(kth), self.top2 + q2[q] - 2.0 * np.where(np.isfinite(kth), kth, 0.0), np.inf)
            return np.sqrt(np.maximum(d2, 0.0))

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if not isinstance(node, tuple):
                best.offer(q, queries, self.x[node], ids[node], ordered_dot, lambda p: slack[p][:, None])
                return
            v, in_lo, in_hi, out_lo, out_hi, inside, outside = node
            d = apart(q, v)
            close = d <= (in_hi + out_lo) / 2
            halves = (inside, np.maximum(in_lo - d, d - in_hi)), (outside, np.maximum(out_lo - d, d - out_hi))
            for first in (True, False):         # each query's own side, then the other
                for (half, gap), mine in zip(halves, (close, ~close), strict=True):
                    go = mine if first else ~mine
                    go = go & (gap <= reach(q) / factor + 1e-6 * scale[q])
                    visit(half, q[go])

        visit(self.root, np.arange(len(queries)))


def _task(factor: float, k: int, leaf: int):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        best = TopK(asked.column("vec_id").to_numpy(), k)
        if rows.num_rows and asked.num_rows:
            VPTree(matrix(rows, "v"), leaf).search(
                matrix(asked, "v"), rows.column("vec_id").to_numpy(), best, factor)
        return best.table(pa.float64())
    return run


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            block_rows: int = BLOCK_ROWS, leaf: int = LEAF) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` vectors found nearest to
    each row whose vec_id is divisible by ``every``."""
    nonzero = F.exists("embedding", lambda x: x != 0)
    vectors, asked, shards, blocks = dealt(embeddings, finite(F.col("embedding")) & nonzero, every, shard_rows, block_rows, k)
    asked = asked.withColumn("shards", F.sequence(F.lit(0), F.lit(shards - 1)))
    return ranked(search(vectors, asked, _task(factor, k, leaf), "double", blocks), k)
