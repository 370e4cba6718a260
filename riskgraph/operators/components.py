"""Weakly connected components by alternating large-star / small-star.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: "Connected Components
in MapReduce and Beyond" (SoCC 2014). Each round is two joins and two
partial aggregates over the edge set; the number of rounds is O(log^2 n)
and hub nodes do not serialise (their minimum is a partial aggregate, their
neighbours meet it in salted runs). The component id is the smallest
node id of the component; isolated nodes are their own component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.joinback import MAX_HEAVY, MIN_HEAVY_ROWS, heavy_keys, salted_join
from riskgraph.session import cut_lineage


def _canonical(e: DataFrame) -> DataFrame:
    return (e.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _both(e: DataFrame) -> DataFrame:
    """Canonical (a<b) edges -> both orientations (u, v)."""
    return (e.select(F.col("a").alias("u"), F.col("b").alias("v"))
            .unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"))))


def _joined_min(rows: DataFrame, least: DataFrame, hubs: tuple[int, int] | None) -> DataFrame:
    """``rows(u, v)`` with their node's minimum ``m`` of ``least(u, m, __n)``; with
    ``hubs`` (see ``heavy_keys``) a hub's rows are cut into salted runs."""
    if hubs is None:
        return rows.join(least.drop("__n"), "u")
    least = cut_lineage(least)
    return salted_join(rows, least.drop("__n"), ["u"], heavy_keys(least, ["u"], max_heavy=hubs[0], min_rows=hubs[1]))


def _large_star(e: DataFrame, hubs: tuple[int, int] | None = None) -> DataFrame:
    both = _both(e)
    m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("__n"))
    out = _joined_min(both.where(F.col("v") > F.col("u")), m, hubs).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _canonical(out)


def _small_star(e: DataFrame, hubs: tuple[int, int] | None = None) -> DataFrame:
    smaller = _both(e).where(F.col("v") < F.col("u"))
    m = smaller.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("__n"))
    moved = _joined_min(smaller, m, hubs).select(F.col("v").alias("u"), F.col("m").alias("v"))
    selfs = m.select("u", F.col("m").alias("v"))
    return _canonical(moved.unionByName(selfs))


def _state(e: DataFrame) -> tuple[int, int, int]:
    """Nodes that are not yet a star leaf with one root or a root, the largest
    number of neighbours and all neighbours: one aggregate, one row to the driver."""
    per = _both(e).groupBy("u").agg(
        F.count_if(F.col("v") < F.col("u")).alias("parents"),
        F.count_if(F.col("v") > F.col("u")).alias("children"))
    bad = (F.col("parents") > 1) | ((F.col("parents") >= 1) & (F.col("children") >= 1))
    r = per.agg(F.count_if(bad).alias("n"), F.max(F.col("parents") + F.col("children")).alias("top"),
                F.sum(F.col("parents") + F.col("children")).alias("all")).first()
    return r["n"], r["top"] or 0, r["all"] or 0


def component_map(edges: DataFrame, max_rounds: int = 200, max_heavy: int = MAX_HEAVY,
                  min_heavy_rows: int = MIN_HEAVY_ROWS) -> DataFrame:
    """``(node, comp)`` for every node that has at least one edge.

    ``edges``: ``(src, dst)`` in any orientation; self-loops are ignored.
    The edge set is written as a table in the checkpoint folder every round. The
    aggregate that tells whether a round is needed also tells whether there are
    hubs; only then the stars are joined with hubs' neighbours over salts.
    """
    e = cut_lineage(_canonical(edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))))
    for _ in range(max_rounds):
        open_, top, total = _state(e)
        if open_ == 0:
            break
        hubs = (max_heavy, min_heavy_rows) if top > max(min_heavy_rows, total // max_heavy) else None
        e = cut_lineage(_small_star(_large_star(e, hubs), hubs))
    else:
        raise RuntimeError("connected components did not converge")
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()
    leaves = e.select(F.col("b").alias("node"), F.col("a").alias("comp"))
    return roots.unionByName(leaves).groupBy("node").agg(F.min("comp").alias("comp"))


def wcc(nodes: DataFrame, edges: DataFrame, out: str = "wccId") -> DataFrame:
    """Component of every node ``(guid, <out>)``; nodes without edges are
    their own component (left join + ``coalesce``)."""
    cm = component_map(edges)
    return (nodes.select("guid")
            .join(cm.withColumnRenamed("node", "guid"), "guid", "left")
            .select("guid", F.coalesce(F.col("comp"), F.col("guid")).alias(out)))


def component_sizes(labels: DataFrame, col: str = "wccId") -> DataFrame:
    return labels.groupBy(col).agg(F.count(F.lit(1)).alias("componentSize"))
