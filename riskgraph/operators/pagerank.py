"""PageRank (unweighted and weighted) by pushing residuals.

The score of a node is ``(1 - d) * sum_k d^k P_k``: what it holds at the start
plus all that ever reaches it. A round is therefore a push: every node of the
*frontier* (whatever it received in the last round, if that is more than
``tol``) sends ``d * received * share`` along its out-edges, and what arrives
is added to the receivers' scores. A node that received no more than the
tolerance sends nothing, a node without anything to send in any run (variant)
has no row left, and the job ends when no run has any. The shares of one
node never add up to more than 1, so whatever is not sent on is bounded by
``tol`` a node and round.

Several runs are pushed together: a node has one row with a residual for each
run, a link one row with its share in each run (none: 0), so a round is one join
and one partial aggregate for all of them, and edges that several runs have in
common are read once.

Semantics: non-normalised ``pr(v) = (1 - d) + d * sum(pr(u) * share(u->v))``;
``share`` is ``1/outdeg(u)`` or ``w/sum(w)`` over u's positive-weight edges;
dangling mass is not redistributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.joinback import join_back
from riskgraph.operators.skew import HotSplit, join_state, split_hot
from riskgraph.session import cut_lineage, cut_lineage_observed, fixed_shuffles, shuffle_partitions

MAX_ITER = 1000
TOLERANCE = 1e-7
ROWS_PER_PART = 500_000


def edge_shares(edges: DataFrame) -> DataFrame:
    """``(variant, src, dst, w)`` -> ``(variant, src, dst, share)``; the out-sums
    are a partial aggregate joined back, with hubs' rows spread by a salt."""
    with_sum = join_back(edges, ["variant", "src"], tot=F.sum("w"))
    return with_sum.select("variant", "src", "dst", (F.col("w") / F.col("tot")).alias("share"))


def _push(links: HotSplit, state: DataFrame, runs: range, damping: float, tol: float) -> DataFrame:
    """One round: ``state(src, r0.., acc0..)`` -> the same one push later.
    The link table holds a pseudo-link of every node to itself (``own``),
    on which the node's scores so far travel, so that the state is read once
    and a round stays one join and one aggregate. Written as SQL expressions, few
    steps a round: a plan of several rounds is analysed anew at each of its steps."""
    least, d = ("null" if tol is None else f"double('{float(tol)!r}')"), f"double('{float(damping)!r}')"
    live = " or ".join(f"r{i} > {least}" for i in runs)
    sent = [f"case when not own and r{i} > {least} then {d} * r{i} * s{i} else 0D end as r{i}" for i in runs]
    kept = [f"case when own then acc{i} else 0D end as acc{i}" for i in runs]
    moved = join_state(links, state).where(f"own or {live}").selectExpr("dst as src", *sent, *kept)
    return moved.groupBy("src").agg(*[F.expr(f"sum(r{i}) as r{i}") for i in runs],
                                    *[F.expr(f"sum(acc{i}) + sum(r{i}) as acc{i}") for i in runs])


def pagerank_many(nodes: DataFrame, variants: dict[str, tuple[DataFrame, bool]],
                  damping: float = 0.85, max_iter: int = MAX_ITER, tol: float = TOLERANCE,
                  cut_every: int = 8, max_hot_keys: int = 10_000, min_hot_degree: int = 100_000) -> DataFrame:
    """Run PageRank for every variant ``name -> (edges(src,dst,w), weighted)``.

    Returns ``(variant, guid, pagerank)`` for every node of ``nodes`` and
    every variant. ``cut_every`` rounds make one plan; its result is written:
    the frontier for the next rounds and, for every node that was reached,
    what it got (a delta, summed once at the end). Only rows of nodes that
    were reached are written, so late plans over a small frontier are small.
    The links are written once, bucketed on ``src`` into as many
    buckets as a round's shuffle has partitions (by their number, not by the
    session's setting, which may be far too many for a small graph): a round's
    aggregate leaves its rows where the next round's join wants them, so a round
    has one exchange and never moves a link. Sources with a huge out-degree are
    split off (``skew.split_hot``) and joined to a broadcast of their own rows (at
    most ``max_hot_keys``), so no bucket holds a hub; a plan then makes one round,
    as both parts read the frontier.
    """
    spark, runs = nodes.sparkSession, range(len(variants))
    weights = [(e.where(F.col("w") > 0) if weighted else e.withColumn("w", F.lit(1.0)))
               .select(F.lit(i).alias("variant"), "src", "dst", F.col("w").cast("double").alias("w"))
               for i, (e, weighted) in enumerate(variants.values())]
    shares = edge_shares(cut_lineage(reduce(DataFrame.unionByName, weights)))
    start = cut_lineage(nodes.groupBy(F.col("guid").alias("src")).agg(F.count(F.lit(1)).cast("double").alias("rows")))
    one = F.col("share")
    edges = shares.join(start.select(F.col("src").alias("dst")), "dst", "left_semi").groupBy("src", "dst").agg(
        *[F.coalesce(F.sum(F.when(F.col("variant") == i, one)), F.lit(0.0)).alias(f"s{i}") for i in runs])
    loops = nodes.select(F.col("guid").alias("src"), F.col("guid").alias("dst"), *[F.lit(0.0).alias(f"s{i}") for i in runs], F.lit(True).alias("own"))
    table, seen = cut_lineage_observed(edges.withColumn("own", F.lit(False)).unionByName(loops), n=F.count(F.lit(1)))
    parts = min(shuffle_partitions(spark), max(spark.sparkContext.defaultParallelism, -(-seen["n"] // ROWS_PER_PART)))
    base = 1.0 - damping
    with fixed_shuffles(spark, parts):
        links = split_hot(table, ["src"], max_hot_keys, min_hot_degree, buckets=parts)
        frontier, reached, done = start.select("src", *[(F.col("rows") * F.lit(base)).alias(f"r{i}") for i in runs]), [], 0
        while done < max_iter:
            state = frontier.select("src", *[f"r{i}" for i in runs], *[F.lit(0.0).alias(f"acc{i}") for i in runs])
            rounds = min(1 if links.n_hot else cut_every, max_iter - done)
            for _ in range(rounds):
                state = _push(links, state, runs, damping, tol)
            some = reduce(Column.__or__, [F.col(f"acc{i}") > 0 for i in runs])
            live = reduce(Column.__or__, [F.col(f"r{i}") > F.lit(tol) for i in runs])
            got, seen = cut_lineage_observed(state.where(some), live=F.count(F.when(live, 1)))
            done += rounds
            reached.append(got.select("src", *[f"acc{i}" for i in runs]))
            if not seen["live"]:
                break
            frontier = got.where(live).select("src", *[f"r{i}" for i in runs])
        first = start.select("src", *[(F.col("rows") * F.lit(base)).alias(f"acc{i}") for i in runs])
        total = reduce(DataFrame.unionByName, [first, *reached]).groupBy("src").agg(
            *[F.sum(f"acc{i}").alias(f"acc{i}") for i in runs])
        each = F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"acc{i}").alias("pagerank"))
                                   for i, v in enumerate(variants)])).alias("x")
        return cut_lineage(total.select("src", each).select("x.variant", F.col("src").alias("guid"), "x.pagerank"))


def pagerank(nodes: DataFrame, edges: DataFrame, weighted: bool = False, damping: float = 0.85,
             max_iter: int = MAX_ITER, tol: float = TOLERANCE) -> DataFrame:
    """Single PageRank run: ``(guid, pagerank)``."""
    r = pagerank_many(nodes, {"pr": (edges, weighted)}, damping, max_iter, tol)
    return r.select("guid", "pagerank")
