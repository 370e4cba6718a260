"""Weighted-Jaccard node similarity (sum of min / sum of max over shared
neighbours) with a similarity cutoff and top-k per node.

Exact, without emitting all pairs of a hub's neighbours:

1. Items with at most ``SMALL`` holders are compared in blocks of nodes: a block
   holds the nodes of one neighbourhood (see ``dealt``) and gets the list of each
   item that it holds once, however many of its nodes share it. The sums of minima
   of a node with all its partners are added up in numpy, and only what can be among
   its ``top_k`` leaves the block, so neither the pairs nor their items are shuffled.
   A block reads at most ``BLOCK_COST`` list entries; a node that would read more on
   its own is paired up by joins. Who is not met shares items with more holders
   ("large" ones) alone. These are light in an inverse-degree graph, and what a
   node holds of them, ``R``, bounds its score with any such node b:
   ``s / (W + W_b - s)`` with ``s = min(R, W_b)``, at most ``R / W``.
2. A node whose kth score is already above that bound is done. The others read
   the lists of their large items best first (a threshold algorithm: Fagin,
   Lotem, Naor: "Optimal Aggregation Algorithms for Middleware", PODS 2001). A list
   is ordered by its holders' total weight; the bound is highest where it
   equals ``R`` and falls to both sides, so a node starts there and reads a block
   of ``BLOCK`` holders to either side a round. Its new pairs are scored, its kth
   score grows, and it stops on a side once the bound of the last one read is
   below the cutoff or its kth score (or equal to it, with no smaller id to come).
   What is read stays near what is kept, however many hold the item.

Scores of the candidates are exact (in a block, where a node holds no large item;
else expand the smaller side, probe the other).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.operators.ranges import numbered, running_sums
from riskgraph.session import cut_lineage, importable, written


SMALL = 1024            # holders of an item that are compared at once
BLOCK = 64              # holders that are read together from a longer list
BLOCK_COST = 8_000_000  # list entries that a block of nodes reads, at most


def _round9(c) -> Column:
    return F.round(c, 9)


def _totals(members: DataFrame, sizes: DataFrame, small: int) -> DataFrame:
    """``(node, tot, R)``: the weight of all items and that of the large ones, rounded
    so that equal weights summed up in another order are equal."""
    large = F.when(F.col("size") > small, F.col("w")).otherwise(F.lit(0.0))
    return members.join(sizes, "item").groupBy("node").agg(
        F.round(F.sum("w"), 12).alias("tot"), F.round(F.sum(large), 12).alias("R"))


def dealt(held: DataFrame, totals: DataFrame, cost: int) -> tuple[DataFrame, DataFrame]:
    """``held(node, item, w, size)`` -> ``(node, blk, n)``: nodes dealt to blocks that
    read at most some ``cost`` list entries (the sizes of a node's items), and ``(node)``
    of those that read more alone. Nodes that reach the same smallest item over one step
    (node, item, node, item) come one after the other, so a block's nodes share lists."""
    own = cut_lineage(held.groupBy("node").agg(F.sum("size").alias("cost"), F.min("item").alias("least")))
    near = held.join(own.select("node", "least"), "node").groupBy("item").agg(F.min("least").alias("least"))
    order = cut_lineage(held.join(near, "item").groupBy("node").agg(F.min("least").alias("least"))
                        .join(own.select("node", "cost"), "node"))
    run = running_sums(order.where(F.col("cost") <= cost), ["least", "node"], upto="cost")
    return (cut_lineage(run.select("node", F.floor((F.col("upto") - 1) / cost).cast("long").alias("blk"))),
            order.where(F.col("cost") > cost).select("node"))


def _compared(cutoff: float, top_k: int):
    """A block's nodes against all holders of their items: ``(a, b, similarity,
    again)``. ``again``: both hold large items too, so the score is to be counted
    anew; of the other partners a node names its ``top_k`` best."""
    def run(key: tuple, mine: pa.Table, lists: pa.Table) -> pa.Table:
        holders, *numbers = (lists.column(c).combine_chunks() for c in ("nodes", "ws", "tots", "Rs"))
        ends = np.r_[0, np.cumsum(pc.list_value_length(holders).to_numpy().astype(np.int64))]
        w, part_tot, part_rest = (c.flatten().to_numpy(zero_copy_only=False) for c in numbers)
        coded = holders.flatten().dictionary_encode()
        sort = pc.sort_indices(coded.dictionary).to_numpy()
        ids, rank = coded.dictionary.take(pa.array(sort)), np.empty(len(sort), np.int64)
        rank[sort] = np.arange(len(sort))
        at, tot, rest = rank[coded.indices.to_numpy()], np.empty(len(sort)), np.empty(len(sort))
        tot[at], rest[at] = part_tot, part_rest
        slot = pc.index_in(mine.column("item"), lists.column("item").combine_chunks()).to_numpy()
        node = pc.index_in(mine.column("node"), ids).to_numpy()
        weight = mine.column("w").to_numpy()
        order = np.argsort(node, kind="stable")
        node, weight, slot = node[order], weight[order], slot[order]
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
        out = ([], [], [], [])
        for lo, hi in zip(starts, np.r_[starts[1:], len(node)], strict=True):
            me = node[lo]
            spans = [(ends[s], ends[s + 1]) for s in slot[lo:hi]]
            who = np.concatenate([at[x:y] for x, y in spans])
            common = np.concatenate([np.minimum(w[x:y], m) for (x, y), m in zip(spans, weight[lo:hi], strict=True)])
            if len(who) * 8 > len(ids):
                met = np.bincount(who, common, len(ids))
                b = np.flatnonzero(met)
                inter = met[b]
            else:
                b, where = np.unique(who, return_inverse=True)
                inter = np.bincount(where, common)
            more = np.minimum(rest[me], rest[b])
            score = inter / (tot[me] + tot[b] - inter)
            bound = (inter + more) / np.maximum(tot[me] + tot[b] - inter - more, inter + more)
            again = more > 0
            keep = (b != me) & np.where(again, bound >= cutoff - 1e-9, score >= cutoff)
            b, score, again = b[keep], score[keep], again[keep]
            known = np.flatnonzero(~again)
            if len(known) > top_k:
                # ids are sorted: equal scores go to the smaller one
                known = known[np.argsort(-np.round(score[known], 9), kind="stable")[:top_k]]
            pick = np.r_[known, np.flatnonzero(again & (b > me))]
            out[0].append(np.full(len(pick), me, np.int64))
            out[1].append(b[pick])
            out[2].append(score[pick])
            out[3].append(again[pick])
        a, b, score, again = (np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, float, bool), strict=True))
        return pa.table([ids.take(pa.array(np.minimum(a, b))), ids.take(pa.array(np.maximum(a, b))), pa.array(score), pa.array(again)],
                        ["a", "b", "similarity", "again"])
    return run


def paired(members: DataFrame, sizes: DataFrame, totals: DataFrame, cutoff: float, top_k: int, small: int = SMALL,
           cost: int = BLOCK_COST) -> DataFrame:
    """``(a, b, similarity)``, ``a < b``: of the pairs that share an item of at most
    ``small`` holders and reach ``cutoff`` the ``top_k`` best of every node, and all of two
    nodes that hold larger items too."""
    spark = members.sparkSession
    importable(spark)
    held = cut_lineage(members.join(sizes.where((F.col("size") > 1) & (F.col("size") <= small)), "item")
                       .select("node", "item", "w", "size"))
    blocks, alone = dealt(held, totals, cost)
    kind = members.schema["node"].dataType.simpleString()

    def lists() -> DataFrame:
        return held.join(totals, "node").groupBy("item").agg(
            F.collect_list(F.struct("node", "w", "tot", "R")).alias("e"))               # small ones at most

    def compared() -> DataFrame:
        mine = cut_lineage(held.join(blocks, "node").select("blk", "node", "item", "w"))
        read = written(spark, lambda: mine.select("blk", "item").distinct().join(cut_lineage(lists()), "item"))
        # an array a column: a shuffled entry is as long as its values
        read = read.select("blk", "item", *[F.col(f"e.{c}").alias(f"{c}s") for c in ("node", "w", "tot", "R")])
        return mine.groupBy("blk").cogroup(read.groupBy("blk")).applyInArrow(
            _compared(cutoff, top_k), f"a {kind}, b {kind}, similarity double, again boolean")
    found = written(spark, compared)
    few = held.join(alone.withColumnRenamed("node", "a"), F.col("node") == F.col("a"), "left_semi").select(F.col("node").alias("a"), "item")
    heavy = few.join(held.select(F.col("node").alias("b"), "item"), "item").where(F.col("a") != F.col("b"))
    recount = cut_lineage(found.where("again").select("a", "b").unionByName(heavy.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct())
    exact = found.where("not again").select("a", "b", "similarity")
    if not recount.take(1):
        return exact.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    anew = pair_scores(members, recount).where(F.col("similarity") >= cutoff)
    return exact.unionByName(anew).groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    """``(node, kth, kth_other)``: score and partner at rank ``k`` of the nodes
    that have as many partners."""
    both = scored.select(F.col("a").alias("node"), F.col("b").alias("other"), _round9("similarity").alias("x")).unionByName(
        scored.select(F.col("b").alias("node"), F.col("a").alias("other"), _round9("similarity").alias("x")))
    w = Window.partitionBy("node").orderBy(F.col("x").desc(), F.col("other").asc())
    # rows up to k alone: planned as a window group limit, before the shuffle too
    return (both.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).where(F.col("rn") == k)
            .select("node", F.col("x").alias("kth"), F.col("other").alias("kth_other")))


def _blocks(lists: DataFrame, up: bool, block: int) -> DataFrame:
    """``(item, side, blk, entries)``: the holders of each large item in order of
    total weight (rising for ``up``), ``block`` at a time, with their positions."""
    order = [F.col("item"), F.col("tot") if up else F.col("tot").desc(), F.col("node")]
    n = numbered(lists, order, "__n")
    start = n.groupBy("item").agg(F.min("__n").alias("__first"))
    pos = n.join(start, "item").withColumn("pos", F.col("__n") - F.col("__first"))
    entry = F.struct("pos", "tot", "node")
    return (pos.groupBy("item", F.lit(up).alias("side"), F.floor(F.col("pos") / block).alias("blk"))
            .agg(F.sort_array(F.collect_list(entry)).alias("entries")))                # block entries at most


def _starts(asking: DataFrame, lists: DataFrame) -> DataFrame:
    """``asking(a, Wa, R, item)`` with ``below``: how many of the item's holders
    weigh less than ``R``. Holders and questions are counted along together in
    ranges of (item, weight)."""
    first = lists.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    held = lists.select("item", F.col("tot").alias("v"), F.lit(1).alias("held"), F.lit(None).cast(asking.schema["a"].dataType).alias("a"),
                        F.lit(None).cast("double").alias("Wa"))
    asked = asking.select("item", F.col("R").alias("v"), F.lit(0).alias("held"), "a", "Wa")
    run = running_sums(held.unionByName(asked), ["item", "v", "held", "a"], upto="held")
    ahead = running_sums(first, ["item"], upto="size").select("item", "size", (F.col("upto") - F.col("size")).alias("ahead"))
    return (run.where(F.col("held") == 0).join(ahead, "item")
            .select("a", "Wa", F.col("v").alias("R"), "item", "size", (F.col("upto") - F.col("ahead")).alias("below")))


def _bound(weight: Column) -> Column:
    """The most that a node (``Wa``, ``R``) can score with one of total ``weight``."""
    s = F.least(F.col("R"), weight)
    return _round9(s / (F.col("Wa") + weight - s) + F.lit(1e-12))


def _may_enter(weight: Column, node: Column, cutoff: float) -> Column:
    """Whether a holder could be among the k best of a node with ``kth``, ``kth_other``."""
    u = _bound(weight)
    return (u >= F.lit(cutoff - 1e-9)) & (F.col("kth").isNull() | (u > F.col("kth"))
                                          | ((u == F.col("kth")) & (node < F.col("kth_other"))))


def scored_pairs(members: DataFrame, cutoff: float, top_k: int, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``(a, b, similarity)``, ``a < b``: pairs with similarity >= ``cutoff``, among
    them the ``top_k`` best of every node (ties to the smaller id).
    ``members``: written distinct ``(node, item, w)`` with finite w > 0."""
    sizes = cut_lineage(members.groupBy("item").agg(F.count(F.lit(1)).alias("size")))
    totals = cut_lineage(_totals(members, sizes, small))
    scored = written(members.sparkSession, lambda: paired(members, sizes, totals, cutoff, top_k, small))
    large = sizes.where(F.col("size") > small).select("item")
    if not large.take(1):
        return scored
    lists = cut_lineage(members.join(large, "item", "left_semi").join(totals.select("node", "tot"), "node")
                        .select("item", "node", "tot"))
    best = cut_lineage(_best(scored, top_k))
    # what a node could still find at most, against what it has
    open_ = cut_lineage(totals.where(F.col("R") > 0).join(best, "node", "left")
                        .select(F.col("node").alias("a"), F.col("tot").alias("Wa"), "R", "kth")
                        .where((_round9(F.col("R") / F.col("Wa") + F.lit(1e-12)) >= F.lit(cutoff - 1e-9))
                               & (F.col("kth").isNull() | (_round9(F.col("R") / F.col("Wa") + F.lit(1e-12)) >= F.col("kth")))))
    if not open_.take(1):
        return scored
    blocks = cut_lineage(_blocks(lists, True, block).unionByName(_blocks(lists, False, block)))
    asking = lists.select("item", F.col("node").alias("a")).join(open_.select("a", "Wa", "R"), "a")
    at = _starts(cut_lineage(asking), lists)
    frontier = cut_lineage(
        at.select("a", "Wa", "R", "item", F.lit(True).alias("side"), F.col("below").alias("pos"), "size").unionByName(
            at.select("a", "Wa", "R", "item", F.lit(False).alias("side"), (F.col("size") - F.col("below")).alias("pos"), "size"))
        .where(F.col("pos") < F.col("size")))
    while frontier.take(1):
        known = frontier.join(best.withColumnRenamed("node", "a"), "a", "left").withColumn("blk", F.floor(F.col("pos") / block))
        read = cut_lineage(known.join(blocks, ["item", "side", "blk"]))
        seen = (read.select("a", "Wa", "R", "pos", "kth", "kth_other", F.explode("entries").alias("e"))
                .where((F.col("e.pos") >= F.col("pos")) & (F.col("e.node") != F.col("a")))
                .where(_may_enter(F.col("e.tot"), F.col("e.node"), cutoff)))
        new = cut_lineage(seen.select(F.least("a", "e.node").alias("a"), F.greatest("a", "e.node").alias("b")).distinct()
                          .join(scored.select("a", "b"), ["a", "b"], "left_anti"))
        scored = cut_lineage(scored.unionByName(pair_scores(members, new).where(F.col("similarity") >= cutoff)))
        best = cut_lineage(_best(scored, top_k))
        last = F.element_at("entries", -1)
        frontier = cut_lineage(
            read.select("a", "Wa", "R", "item", "side", "size", "blk", last["tot"].alias("last"), last["node"].alias("last_node"))
            .withColumn("pos", (F.col("blk") + 1) * block).where(F.col("pos") < F.col("size"))
            .join(best.withColumnRenamed("node", "a"), "a", "left")
            .where(_may_enter(F.col("last"), F.col("last_node"), cutoff))
            .select("a", "Wa", "R", "item", "side", "pos", "size"))
    return scored


def pair_scores(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact weighted Jaccard of each pair ``(a, b)``: the side with fewer
    items is expanded and the other side probed by key, so the work per
    pair is min(|items(a)|, |items(b)|)."""
    stats = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("W"))
    p = (pairs.join(stats.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("W").alias("Wa")), "a")
         .join(stats.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("W").alias("Wb")), "b"))
    a_small = F.col("na") <= F.col("nb")
    p = p.select("a", "b", "Wa", "Wb",
                 F.when(a_small, F.col("a")).otherwise(F.col("b")).alias("s"),
                 F.when(a_small, F.col("b")).otherwise(F.col("a")).alias("o"))
    m = members.select("node", "item", "w")
    x = (p.join(m.select(F.col("node").alias("s"), "item", F.col("w").alias("ws")), "s")
         .join(m.select(F.col("node").alias("o"), "item", F.col("w").alias("wo")), ["o", "item"]))
    inter = x.groupBy("a", "b", "Wa", "Wb").agg(F.sum(F.least("ws", "wo")).alias("I"))
    return inter.select("a", "b", (F.col("I") / (F.col("Wa") + F.col("Wb") - F.col("I"))).alias("similarity"))


def copy_groups(members: DataFrame) -> DataFrame:
    """``(node, grp)``: nodes with identical (item, weight) sets share ``grp``
    (the smallest node of the group). The set signature is two independent
    order-free 64-bit hash XORs (items are distinct per node) plus the size,
    all partial aggregates, so a group holding a third of the nodes is
    combined map-side."""
    sig = members.groupBy("node").agg(
        F.bit_xor(F.xxhash64("item", "w")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(17), "item", "w")).alias("h2"),
        F.count(F.lit(1)).alias("n"))
    grp = sig.groupBy("h1", "h2", "n").agg(F.min("node").alias("grp"))
    return sig.join(grp, ["h1", "h2", "n"]).select("node", "grp")


def _smallest_members(groups: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest nodes of every group ``(grp, member)``. The
    row_number filter is planned as a window group limit, applied before
    the shuffle too, so a huge group ships only k rows per partition."""
    w = Window.partitionBy("grp").orderBy("node")
    return (groups.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
            .select("grp", F.col("node").alias("member")))


def node_similarity(members: DataFrame, cutoff: float = 0.01, top_k: int = 10) -> DataFrame:
    """``members``: ``(node, item, w)`` (parallel memberships are merged to one,
    keeping the largest weight). Returns directed ``(node1, node2,
    similarity)``: for every node its ``top_k`` most similar others with
    similarity >= ``cutoff``; ties go to the smaller id.

    Nodes with identical item sets ("copies") are collapsed to one
    representative first: copies are similar with score 1, and a copy's
    score with anyone else equals its representative's. Pairs are then
    scored between representatives only and expanded back, emitting at most
    ``2 * top_k`` rows per node, so a copy group holding a third of all nodes
    never produces its pairs.

    A node with an infinite total weight (it holds an item of infinite
    weight) has similarity 0 with everyone and is left out when
    ``cutoff > 0``.
    """
    if cutoff <= 0:
        raise ValueError("cutoff must be > 0: a pair without a shared item scores 0")
    m = members.groupBy("node", "item").agg(F.max("w").alias("w"))
    inf = float("inf")
    finite_nodes = m.groupBy("node").agg(F.max("w").alias("mx")).where(F.col("mx") < inf).select("node")
    spark = members.sparkSession

    def represented() -> tuple[DataFrame, DataFrame]:
        """Copy groups and their representatives' members, each read by several branches."""
        own = cut_lineage(m.join(finite_nodes, "node", "left_semi").where(F.col("w") > 0))
        groups = cut_lineage(copy_groups(own))
        reps = groups.where(F.col("node") == F.col("grp")).select("node")
        return groups, cut_lineage(own.join(reps, "node", "left_semi"))
    groups, m_rep = written(spark, represented)
    scored = written(spark, lambda: scored_pairs(m_rep, cutoff, top_k))
    rep_pairs = (scored.select(F.col("a").alias("g1"), F.col("b").alias("g2"), "similarity")
                 .unionByName(scored.select(F.col("b").alias("g1"), F.col("a").alias("g2"), "similarity")))
    smallest = _smallest_members(groups, top_k + 1)
    # per representative: its best non-copy partners, expanded to members
    by_rep = Window.partitionBy("g1").orderBy(F.round("similarity", 9).desc(), F.col("node2").asc())
    rep_list = (rep_pairs.join(smallest.withColumnRenamed("grp", "g2"), "g2")
                .select("g1", F.col("member").alias("node2"), "similarity")
                .withColumn("__rn", F.row_number().over(by_rep)).where(F.col("__rn") <= top_k)
                .drop("__rn"))
    others = groups.withColumnRenamed("grp", "g1").join(rep_list, "g1").select(
        F.col("node").alias("node1"), "node2", "similarity")
    copies = (groups.join(smallest, "grp").where(F.col("member") != F.col("node"))
              .select(F.col("node").alias("node1"), F.col("member").alias("node2"),
                      F.lit(1.0).alias("similarity")))
    both = copies.unionByName(others)
    w = Window.partitionBy("node1").orderBy(F.round("similarity", 9).desc(), F.col("node2").asc())
    return both.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= top_k).drop("__rn")
