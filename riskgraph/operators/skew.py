"""Hot/cold split of a static edge table that an iterative job joins every
round with a per-key state table (ranks, communities).

Bucketing the edge table on the join key removes the per-round edge
shuffle, but it also puts every edge of a hot key (a node holding a third
of all edges) into one bucket, i.e. one task, and AQE cannot split skew
without a shuffle. So keys with more than ``max(min_hot_degree,
|E| / max_hot_keys)`` edges are split off: their edges stay a plain table
(scanned in parallel splits) and are joined to a broadcast of only those
keys' state rows, whose count is bounded by ``max_hot_keys`` by
construction. The remaining (cold) edges are bucketed and balanced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.session import bucketed_table, cut_lineage, cut_lineage_observed, shuffle_partitions


@dataclass
class HotSplit:
    cold: DataFrame                 # bucketed on ``key``
    hot: DataFrame | None           # plain table, edges of hot keys
    hot_keys: DataFrame | None      # at most ``max_hot_keys`` rows
    key: list[str]
    n_hot: int
    buckets: int                    # bucket count of ``cold``; state tables use the same


def bucket_count(spark, rows: int, rows_per_bucket: int = 1_000_000) -> int:
    """About ``rows_per_bucket`` rows per bucket, at most the session's
    shuffle-partition count (sized for the cluster at submit time)."""
    return max(1, min(shuffle_partitions(spark), -(-rows // rows_per_bucket)))


def split_hot(edges: DataFrame, key: list[str], max_hot_keys: int = 10_000,
              min_hot_degree: int = 100_000, rows_per_bucket: int = 1_000_000, buckets: int | None = None) -> HotSplit:
    degrees = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("__deg"))
    stats = degrees.agg(F.sum("__deg").alias("total"), F.max("__deg").alias("top")).first()
    total, top = stats["total"] or 0, stats["top"] or 0
    threshold = max(min_hot_degree, -(-total // max_hot_keys))
    n = buckets or bucket_count(edges.sparkSession, total, rows_per_bucket)
    if top <= threshold:          # the common case: no hot key, one aggregate
        return HotSplit(bucketed_table(edges, key, n), None, None, key, 0, n)
    hot_keys, obs = cut_lineage_observed(degrees.where(F.col("__deg") > threshold).select(*key),
                                         n=F.count(F.lit(1)))
    n_hot = obs["n"]
    # hot_keys has at most max_hot_keys rows: broadcasting it is bounded
    cold = bucketed_table(edges.join(F.broadcast(hot_keys), key, "left_anti"), key, n)
    hot = cut_lineage(edges.join(F.broadcast(hot_keys), key, "left_semi"))
    return HotSplit(cold, hot, hot_keys, key, n_hot, n)


def join_state(split: HotSplit, state: DataFrame) -> DataFrame:
    """Edges joined to ``state`` (one row per key, key columns named like the
    split's key): a bucketed join for cold keys plus a broadcast join of the
    hot keys' state rows for hot keys."""
    cold = split.cold.join(state, split.key)
    if split.n_hot == 0:
        return cold
    hot_state = state.join(F.broadcast(split.hot_keys), split.key, "left_semi")
    hot = split.hot.join(F.broadcast(hot_state), split.key)
    return cold.unionByName(hot)
