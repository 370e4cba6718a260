"""Searching vectors in shards: rows are dealt to shards by hash and queries to
blocks; a task meets one shard and one block of queries, builds the shard's
tree and searches it for the block. Both sides have a bounded size, whatever
the table's: rows that repeat a vec_id and its vector are counted first, and k
of them go to the shards, each dealt on its own (a query can rank no more than k
of them, and they are alike). Vectors of different lengths never meet."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskgraph.llm.common import cut_lineage

SHARD_ROWS, BLOCK_ROWS = 8192, 8192


def finite(embedding: Column) -> Column:
    """False for null, empty, or a component that is null or not finite."""
    ok = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ok, F.lit(False))


def matrix(t: pa.Table, name: str) -> np.ndarray:
    """The list column as a matrix (every list has the same length)."""
    if not t.num_rows:
        return np.zeros((0, 0))
    flat = t.column(name).combine_chunks().flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(t.num_rows, -1)


class TopK:
    """The k best (score, id) of each query: highest score, ties to smaller id.
    A score is the sum of two doubles, of which the second is zero but for whole
    numbers that one double cannot hold."""

    def __init__(self, own: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.own, self.k = own, k
        self.score = np.full((len(own), k), -np.inf)
        self.low = np.zeros((len(own), k))
        self.id = np.full((len(own), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(own), -np.inf) if floor is None else floor
        self.cap = np.inf           # scores beyond it, to either side, are equal

    def kth(self, q: np.ndarray) -> np.ndarray:
        """What a candidate must reach at least: the kth score so far, or the
        one that another shard has already shared."""
        return np.maximum(self.score[q, -1], self.floor[q])

    def offer(self, q: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray,
              exact: Callable, slack: Callable, step: int = 512) -> None:
        """Candidates ``rows`` for the queries numbered ``q``. A matrix product
        picks what can enter, ``exact(queries, rows)`` scores it in pairs.
        ``slack(q)``: how far a product may be off, queries x rows."""
        for a in range(0, len(q), step):
            part = q[a:a + step]
            rough, off = queries[part] @ rows.T, slack(part)
            own = ids[None, :] == self.own[part][:, None]
            least = np.where(own, -np.inf, np.clip(rough - off, -self.cap, self.cap))
            bound = self.kth(part)
            if rows.shape[0] > self.k:
                bound = np.maximum(bound, np.partition(least, -self.k, axis=1)[:, -self.k])
            r, c = np.nonzero((np.maximum(rough + off, -self.cap) >= bound[:, None]) & ~own)
            if not len(r):
                continue
            hit = np.unique(r)
            width = int(np.bincount(r).max())
            col = np.arange(len(r)) - np.searchsorted(r, r)
            score = np.full((len(hit), width), -np.inf)
            low = np.zeros((len(hit), width))
            ident = np.full((len(hit), width), np.iinfo(np.int64).max)
            at = np.searchsorted(hit, r)
            for z in range(0, len(r), 65536):
                s = slice(z, z + 65536)
                score[at[s], col[s]], low[at[s], col[s]] = exact(queries[part[r[s]]], rows[c[s]])
            ident[at, col] = ids[c]
            who = part[hit]
            score = np.concatenate([self.score[who], score], axis=1)
            low = np.concatenate([self.low[who], low], axis=1)
            ident = np.concatenate([self.id[who], ident], axis=1)
            order = np.lexsort((ident, -low, -score), axis=1)[:, :self.k]
            self.score[who] = np.take_along_axis(score, order, 1)
            self.low[who] = np.take_along_axis(low, order, 1)
            self.id[who] = np.take_along_axis(ident, order, 1)

    def table(self, kind: pa.DataType) -> pa.Table:
        q, c = np.nonzero(self.score > -np.inf)
        score = self.score[q, c]
        if pa.types.is_integer(kind):
            score = [int(x) + int(y) for x, y in zip(score.tolist(), self.low[q, c].tolist(), strict=True)]
        return pa.table({"query_id": pa.array(self.own[q], pa.int64()), "vec_id": pa.array(self.id[q, c], pa.int64()),
                         "score": pa.array(score, kind)})


def ordered_dot(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Inner products of the rows in pairs, summed in component order, so that
    equal vectors get equal scores wherever they stand."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out, 0.0


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def search(vectors: DataFrame, queries: DataFrame, task: Callable[[pa.Table, pa.Table], pa.Table], score: str,
           blocks: int) -> DataFrame:
    """Runs ``task(shard rows, block of queries)`` for each shard and block.

    ``vectors(vec_id, v, dim, shard)`` goes once to every block and
    ``queries(vec_id, v, dim, block, floor, shards)`` to every shard named in
    ``shards``."""
    rows = vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("shard", F.explode("shards")).drop("shards")
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])       # not the attributes of ``vectors``
    keys = ["dim", "shard", "block"]
    return (rows.groupBy(*keys).cogroup(asked.groupBy(*keys))
            .applyInArrow(task, f"query_id long, vec_id long, score {score}"))


def dealt(embeddings: DataFrame, keep: Column, every: int, shard_rows: int, block_rows: int, k: int):
    """(vectors, queries, shards, blocks). Queries are the rows whose vec_id is
    divisible by ``every``; a repeated vec_id asks once, with its smallest
    vector."""
    v = cut_lineage(embeddings.where(keep & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
        F.size("embedding").alias("dim")).groupBy("vec_id", "v", "dim").agg(
        F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies")))
    asked = v.where(F.col("vec_id") % every == 0)
    n = v.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard_rows)), max(1, -(-n["q"] // block_rows))
    h = F.xxhash64("vec_id", "v", "copy")
    vectors = (v.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
               .withColumn("shard", F.pmod(h, F.lit(shards)).cast("int")).drop("copy", "copies"))
    asked = (asked.groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("x")).select("vec_id", "x.v", "x.dim")
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")))
    return vectors, asked, shards, blocks


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over its shards (at most k rows a shard)."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
