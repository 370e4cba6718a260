"""Louvain modularity communities as iterative DataFrame jobs.

Blondel, Guillaume, Lambiotte, Lefebvre: "Fast unfolding of communities in
large networks" (J. Stat. Mech. 2008). Phase 1 moves nodes to the
neighbouring community with the best modularity gain; phase 2 contracts
communities into nodes (self-loops keep the internal weight) and repeats.

Parallel (synchronous) moves can swap two nodes forever, so in each round
only the nodes whose hash parity matches the round may move. Every round is a handful of joins and partial aggregates
over the edge table; the best target per node is a ``min`` over
(-score, community) structs, a partial aggregate, so a hub's many
neighbour communities are combined map-side. The community table is
written out every round.

Graph convention: ``edges`` are symmetric entries ``(src, dst, w)``; an
undirected edge appears as two entries, a self-loop entry carries the
loop's full weight. ``2m`` is the sum of all entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.skew import HotSplit, join_state, split_hot
from riskgraph.session import cut_lineage, cut_lineage_observed


def symmetric_entries(undirected: DataFrame | None = None, directed: DataFrame | None = None) -> DataFrame:
    """Weighted symmetric entries of (A + A^T) / 2 for directed edges and of
    A for undirected ones; inputs are ``(src, dst, w)``. Each input is read once:
    a pair's weights are summed up and then written both ways round."""
    ends = [F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")]
    parts = []
    if undirected is not None:
        parts.append(undirected.where("src is not null and dst is not null").select(*ends, "w"))
    if directed is not None:
        half = F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(F.col("w") / 2)
        parts.append(directed.where("src is not null and dst is not null").select(*ends, half.alias("w")))
    e = parts[0]
    for p in parts[1:]:
        e = e.unionByName(p)
    one, other = F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    ways = F.when(F.col("src") == F.col("dst"), F.array(one)).otherwise(F.array(one, other))
    return (e.groupBy("src", "dst").agg(F.sum("w").alias("w"))
            .select(F.explode(ways).alias("x"), "w").select("x.src", "x.dst", "w"))


def modularity_table(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """One row: ``(weight, communities, modularity)`` of a partition
    ``assign(node, community)``; weight is the sum of all entries (2m), and only
    communities with an edge count. Q is 0 without edges."""
    a = assign.select(F.col("node").alias("src"), F.col("community").alias("cs"))
    b = assign.select(F.col("node").alias("dst"), F.col("community").alias("cd"))
    e = edges.join(a, "src").join(b, "dst")
    per = e.groupBy("cs").agg(F.sum(F.when(F.col("cs") == F.col("cd"), F.col("w")).otherwise(0.0)).alias("inside"),
                              F.sum("w").alias("tot"))
    all_ = per.agg(F.coalesce(F.sum("inside"), F.lit(0.0)).alias("i"), F.count(F.lit(1)).alias("communities"),
                   F.coalesce(F.sum(F.col("tot") * F.col("tot")), F.lit(0.0)).alias("t2"),
                   F.coalesce(F.sum("tot"), F.lit(0.0)).alias("weight"))
    q = F.try_divide("i", "weight") - F.try_divide("t2", F.col("weight") * F.col("weight"))
    return all_.select("weight", "communities", F.coalesce(q, F.lit(0.0)).alias("modularity"))


def modularity(edges: DataFrame, assign: DataFrame) -> float:
    """Q of a partition ``assign(node, community)`` (one scalar)."""
    return modularity_table(edges, assign).first()["modularity"]


def best_moves(kin: DataFrame, comm: DataFrame, tot: DataFrame, m: float) -> DataFrame:
    """``(node, b, kin_own)``: each node's best other community ``b`` = (-score,
    community), ties to the smaller, and its weight into its own. ``kin``: ``(node,
    cv, kin)``, weight from a node to a community; ``comm``: ``(node, k, c)``; ``tot``:
    ``(c, tot)``. The score is the part of the gain that depends on the target."""
    rows = (kin.join(comm, "node")
            .join(tot.select(F.col("c").alias("cv"), F.col("tot").alias("tot_d")), "cv"))
    return _best_of(rows, m)


def _best_of(rows: DataFrame, m: float) -> DataFrame:
    """``best_moves`` of ``(node, c, k, cv, kin, tot_d)``."""
    score = F.col("kin") / F.lit(m) - F.col("k") * F.col("tot_d") / F.lit(2.0 * m * m)
    return rows.groupBy("node").agg(
        F.min(F.when(F.col("cv") != F.col("c"),
                     F.struct((-F.round(score, 15)).alias("ns"), F.col("cv").alias("cv")))).alias("b"),
        F.sum(F.when(F.col("cv") == F.col("c"), F.col("kin")).otherwise(0.0)).alias("kin_own"))


def first_moves(edges: DataFrame) -> DataFrame:
    """``(node, target, score)``: where each node with neighbours would go first,
    from a partition in which every node is alone. Communities are nodes here, so
    a link gets the degrees of its two ends once and serves both of them."""
    edges, obs = cut_lineage_observed(edges, s=F.sum("w"))
    k = cut_lineage(edges.groupBy("src").agg(F.sum("w").alias("k")))
    end = lambda c: k.select(F.col("src").alias(c), F.col("k").alias(f"k_{c}"))
    links = edges.where("src < dst").join(end("src"), "src").join(end("dst"), "dst")
    way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("cv"), F.col(f"k_{a}").alias("k"),
                                F.col(f"k_{b}").alias("tot_d"))
    rows = (links.select(F.explode(F.array(way("src", "dst"), way("dst", "src"))).alias("x"), F.col("w").alias("kin"))
            .select("x.*", "kin", F.col("x.node").alias("c")))
    best = _best_of(rows, (obs["s"] or 0.0) / 2.0)
    return best.select("node", F.col("b.cv").alias("target"), (-F.col("b.ns")).alias("score"))


def may_move(node: str, level: int, it: int):
    """Whether the node may move in this round: a half of the nodes, by hash, in an
    even round and the other half in the next."""
    return F.pmod(F.xxhash64(F.col(node), F.lit(level), F.lit(it // 2)), F.lit(2)) == it % 2


def weights_to_communities(links: HotSplit, comm: DataFrame, level: int, it: int) -> DataFrame:
    """``(node, cv, kin)``: the weight from each node that may move in this round to
    its neighbours' communities. The links of the other half are not read further."""
    return (join_state(links, comm.select(F.col("node").alias("dst"), F.col("c").alias("cv")))
            .where(may_move("src", level, it))
            .groupBy(F.col("src").alias("node"), "cv").agg(F.sum("w").alias("kin")))


def _one_level(edges: DataFrame, two_m: float, level: int, max_iter: int,
               tolerance: float,
               hot: tuple[int, int] = (10_000, 100_000)) -> tuple[DataFrame, int, float]:
    """Local moving on one level over the nodes that have edges (a node
    without edges never moves). Returns ``(node, community)``, the number of
    moves and the summed gain of the moves (the level's modularity gain,
    up to simultaneous-move effects).

    For node i in C with degree k, the gain of moving to D is
    ``(kin_D - kin_C)/m - k (tot_D - tot_C + k) / (2 m^2)``; its arg max over
    D depends only on ``kin_D/m - k tot_D/(2 m^2)``, so the best target, the
    weight into the own community and the final gain all come out of ONE
    partial aggregate per node. Only a hash-chosen half of the nodes may
    move in an even round and the other half in the next, so neighbours rarely
    swap places; two such rounds that together move nothing or gain less than
    ``tolerance`` (sum of the movers' gains) end the level.
    """
    m = two_m / 2.0
    # The community table is written bucketed on the node and the level's
    # links bucketed on their target (hub targets split off and joined by a
    # bounded broadcast), so the per-round join of links to the communities
    # of their targets never reshuffles the edges.
    links = split_hot(edges.where(F.col("src") != F.col("dst")), ["dst"], *hot)
    comm, _ = cut_lineage_observed(
        edges.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"))
        .select("node", "k", F.col("node").alias("c")),
        bucket_by=["node"], buckets=links.buckets, n=F.count(F.lit(1)))
    total_moves, total_gain, last_moved, last_gained = 0, 0.0, 0, 0.0
    for it in range(max_iter):
        tot = comm.groupBy("c").agg(F.sum("k").alias("tot"))
        best = best_moves(weights_to_communities(links, comm, level, it), comm, tot, m)
        cur = comm.join(best, "node", "left").join(tot, "c")
        gain = (-F.col("b.ns") - F.col("kin_own") / F.lit(m)
                + F.col("k") * (F.col("tot") - F.col("k")) / F.lit(2.0 * m * m))
        go = F.col("b").isNotNull() & (gain > F.lit(1e-12))         # without b: may not move, or has no neighbours
        comm, r = cut_lineage_observed(
            cur.select("node", F.when(go, F.col("b.cv")).otherwise(F.col("c")).alias("c"), "k",
                       F.when(go, gain).alias("gain")),
            bucket_by=["node"], buckets=links.buckets, n=F.count("gain"), g=F.sum("gain"))
        n_moved, gained = r["n"], r["g"] or 0.0
        comm = comm.drop("gain")
        total_moves += n_moved
        total_gain += gained
        # an even round and the next have offered every node a move
        if it % 2 == 1 and (n_moved + last_moved == 0 or gained + last_gained < tolerance):
            break
        last_moved, last_gained = n_moved, gained
    return comm.select("node", F.col("c").alias("community")), total_moves, total_gain


def louvain(nodes: DataFrame, edges: DataFrame, max_levels: int = 10, max_iter: int = 10,
            tolerance: float = 1e-4,
            max_hot_keys: int = 10_000, min_hot_degree: int = 100_000) -> DataFrame:
    """Communities ``(node, community)`` for every node of ``nodes(node)``.

    ``edges``: symmetric entries ``(src, dst, w)`` (see ``symmetric_entries``).
    Stops when a level moves no node, when a level gains less than
    ``tolerance`` modularity, or after ``max_levels``. Modularity is measured after
    each level (moves made at once may get in each other's way); a level that
    lowered it is taken back and is the last. Nodes without edges stay in their
    own community.
    """
    edges, obs = cut_lineage_observed(edges.groupBy("src", "dst").agg(F.sum("w").alias("w")),
                                      s=F.sum("w"))
    two_m = obs["s"] or 0.0
    assign = nodes.select("node", F.col("node").alias("community"))
    if two_m == 0:
        return cut_lineage(assign)
    alone = edges.select(F.col("src").alias("node")).distinct()
    q = modularity(edges, alone.select("node", F.col("node").alias("community")))
    for level in range(max_levels):
        comm, moves, _ = _one_level(edges, two_m, level, max_iter, tolerance,
                                         (max_hot_keys, min_hot_degree))
        if moves == 0:
            break
        before, q = q, modularity(edges, comm)
        if q < before:
            break
        nc = comm.select(F.col("node").alias("community"), F.col("community").alias("nc"))
        assign = cut_lineage(assign.join(nc, "community", "left")
                             .select("node", F.coalesce(F.col("nc"), F.col("community")).alias("community")))
        cs = comm.select(F.col("node").alias("src"), F.col("community").alias("cs"))
        cd = comm.select(F.col("node").alias("dst"), F.col("community").alias("cd"))
        edges = cut_lineage(edges.join(cs, "src").join(cd, "dst")
                            .groupBy(F.col("cs").alias("src"), F.col("cd").alias("dst")).agg(F.sum("w").alias("w")))
        if q - before < tolerance:
            break
    return assign
