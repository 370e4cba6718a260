"""Exact top-k by integer inner product: a ball tree per shard, branch and
bound by the inner product's upper bound, with the kth score shared.

Components become floor(1024 x). A node holds the centre and radius of its
points; for a query q no point of it scores above q.centre + |q| radius. A query
enters the child with the higher bound first and leaves out nodes whose bound
is below its kth score so far. That score is shared: all queries are first
searched in one shard, and take the kth score found there into all others, so
those begin to prune at once (the bound is a true one, nothing is lost).

Scores are exact: products run in double precision where no sum can reach 2^52
(Cauchy-Schwarz), else in whole numbers of any length. A score that a long cannot
hold is the nearest long, and is ranked as that.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part; a scaled component beyond 2^200 counts as 2^200; every row
is a candidate, also rows that repeat a vec_id; a repeated vec_id asks once (its
smallest vector) and never finds rows of its own vec_id; ties go to the smaller
vec_id; vectors of another length are no candidates; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage
from riskgraph.llm.shards import BLOCK_ROWS, SHARD_ROWS, TopK, dealt, finite, matrix, norms, ordered_dot, ranked, search

LEAF = 128
OFF = 1e-10         # rounding of a product, as a share of the two vectors' norms, at most


LONG = (1 << 63) - 1


def whole_dot(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products of rows of whole numbers, in pairs, as two doubles."""
    high, _ = ordered_dot(a, b)
    low = np.zeros(len(a))
    for i in np.flatnonzero(norms(a) * norms(b) >= 2.0 ** 52):
        s = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True))
        s = min(max(s, -LONG - 1), LONG)
        high[i] = float(s)
        low[i] = s - int(high[i])
    return high, low


class BallTree:
    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.norm = x, norms(x)
        self.root = self._build(np.arange(len(x)), leaf)

    def _build(self, rows: np.ndarray, leaf: int):
        """(centre, radius, rows or None, left, right, largest norm); split at the
        median along the line between two far points."""
        x, top = self.x[rows], float(self.norm[rows].max())
        centre = x.mean(axis=0)
        d2 = np.einsum("ij,ij->i", x - centre, x - centre)
        radius = float(np.sqrt(d2.max()))
        if len(rows) <= leaf or radius == 0.0:
            return centre, radius, rows, None, None, top
        a = x[int(d2.argmax())]
        b = x[int(np.einsum("ij,ij->i", x - a, x - a).argmax())]
        order = np.argsort(x @ (b - a), kind="stable")
        half = len(rows) // 2
        return (centre, radius, None, self._build(rows[order[:half]], leaf), self._build(rows[order[half:]], leaf),
                top)

    def search(self, queries: np.ndarray, ids: np.ndarray, best: TopK) -> None:
        norm, best.cap = norms(queries), float(LONG)

        def bound(node, q: np.ndarray) -> np.ndarray:
            return np.maximum(queries[q] @ node[0] + norm[q] * (node[1] + OFF * node[5]) + OFF, -best.cap)

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if node[2] is not None:
                off = OFF * self.norm[node[2]]
                best.offer(q, queries, self.x[node[2]], ids[node[2]], whole_dot, lambda p: norm[p][:, None] * off + OFF)
                return
            left, right = bound(node[3], q), bound(node[4], q)
            higher = left >= right
            for first in (True, False):
                for child, ub, mine in ((node[3], left, higher), (node[4], right, ~higher)):
                    go = (mine if first else ~mine) & (ub >= best.kth(q))
                    visit(child, q[go])

        visit(self.root, np.arange(len(queries)))


def _task(k: int, leaf: int):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        floor = asked.column("floor").to_numpy().astype(np.float64) if asked.num_rows else None
        best = TopK(asked.column("vec_id").to_numpy(), k, floor)
        if rows.num_rows and asked.num_rows:
            BallTree(matrix(rows, "v"), leaf).search(matrix(asked, "v"), rows.column("vec_id").to_numpy(), best)
        return best.table(pa.int64())
    return run


def topk(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, shard_rows: int = SHARD_ROWS,
         block_rows: int = BLOCK_ROWS, leaf: int = LEAF) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner
    products of each row whose vec_id is divisible by ``every``."""
    def whole(x):
        y = F.greatest(F.least(x.cast("double") * scale, F.lit(2.0 ** 200)), F.lit(-2.0 ** 200))
        return F.when(F.abs(y) < 2.0 ** 52, F.floor(y).cast("double")).otherwise(y)     # beyond, doubles are whole
    kept = embeddings.where(finite(F.col("embedding"))).select("vec_id", F.transform("embedding", whole).alias("embedding"))
    vectors, asked, shards, blocks = dealt(kept, F.lit(True), every, shard_rows, block_rows, k)
    none = F.lit(float("-inf"))
    run = _task(k, leaf)
    seed = cut_lineage(search(vectors.where("shard = 0"), asked.withColumn("floor", none).withColumn(
        "shards", F.array(F.lit(0))), run, "long", blocks))
    if shards == 1:
        return ranked(seed, k)
    shared = (seed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("kth"))
              .where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "kth"))
    asked = (asked.join(shared, "vec_id", "left").withColumn("floor", F.coalesce("kth", none)).drop("kth")
             .withColumn("shards", F.sequence(F.lit(1), F.lit(shards - 1))))
    rest = search(vectors.where("shard > 0"), asked, run, "long", blocks)
    return ranked(seed.unionByName(rest), k)
