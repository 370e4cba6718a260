"""Entity-resolution rules and fraud-risk labelling as join plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.joinback import MAX_HEAVY, MIN_HEAVY_ROWS, heavy_keys, join_back, salted_join
from riskgraph.session import cut_lineage

def er_p2p_shared_card(p2p: DataFrame, has_cc: DataFrame, max_heavy: int = MAX_HEAVY,
                       min_heavy_rows: int = MIN_HEAVY_ROWS) -> DataFrame:
    """Rule 1: u1 sent money to u2 and both hold the same card.

    For each distinct transfer pair (u1 != u2) the side with FEWER cards is
    expanded to its cards and the other side's (user, card) set probed by
    a semi-join: the work per pair is min(cards(u1), cards(u2)), never a
    card self-join, so neither hub cards nor card-hoarding users square.
    Users who are in very many of the pairs are spread over salts in each of
    the joins. Output: directed ``(start_guid, end_guid)``, one row per pair.
    """
    pairs = cut_lineage(p2p.select(F.col("start_guid").alias("u1"), F.col("end_guid").alias("u2"))
                        .where(F.col("u1") != F.col("u2")).distinct())
    cc = cut_lineage(has_cc.select(F.col("start_guid").alias("user"), F.col("end_guid").alias("card")).distinct())
    often = cut_lineage(pairs.select("u1").unionByName(pairs.select(F.col("u2").alias("u1")))
                        .groupBy(F.col("u1").alias("user")).agg(F.count(F.lit(1)).alias("__n")))
    heavy = heavy_keys(often, ["user"], max_heavy=max_heavy, min_rows=min_heavy_rows)

    def join(rows: DataFrame, side: DataFrame, user: str, more: tuple = (), how: str = "inner") -> DataFrame:
        named = heavy.withColumnRenamed("user", user) if heavy is not None else None
        return salted_join(rows, side.withColumnRenamed("user", user), [user, *more], named, how)

    n = cut_lineage(cc.groupBy("user").agg(F.count(F.lit(1)).alias("n")))
    p = join(join(pairs, n.withColumnRenamed("n", "n1"), "u1"), n.withColumnRenamed("n", "n2"), "u2")
    first_small = F.col("n1") <= F.col("n2")
    p = p.select("u1", "u2", F.when(first_small, F.col("u1")).otherwise(F.col("u2")).alias("s"),
                 F.when(first_small, F.col("u2")).otherwise(F.col("u1")).alias("o"))
    a = join(p, cc, "s")
    b = join(a, cc, "o", ("card",), "left_semi")
    return b.select(F.col("u1").alias("start_guid"), F.col("u2").alias("end_guid")).distinct()


def er_shared_ids(id_edges: DataFrame, id_degree: DataFrame, max_degree: int = 10,
                  min_shared: int = 3) -> DataFrame:
    """Rule 2: u1 < u2 share a card or device of degree <= ``max_degree`` and
    share at least ``min_shared`` distinct identifiers of any type.

    Candidates come only from low-degree cards/devices (at most
    C(max_degree, 2) pairs each). Shared identifiers are then counted per
    candidate by expanding the side with FEWER identifiers and probing the
    other side's (user, identifier) set with a semi-join: the work per pair
    is min(|ids(u1)|, |ids(u2)|), IP hubs are never self-joined.
    ``id_degree``: ``(guid, degree)`` of identifiers over all users. Identifiers
    of several labels are told apart by ``end_guid`` alone: give edges and degrees
    with the ids of ``dictionary.py`` where labels may share guids.
    Output: ``(start_guid, end_guid)`` with start < end.
    """
    member = id_edges.select(F.col("start_guid").alias("user"), F.col("end_guid").alias("id"), "rel")
    # a user's identifiers once, and whether a card or device tells of them: the one
    # shuffle of all edges; all else reads this table
    ids = cut_lineage(member.groupBy("user", "id").agg(F.max(F.col("rel").isin("HAS_CC", "USED")).alias("own")))
    low_ids = id_degree.where(F.col("degree") <= max_degree).select(F.col("guid").alias("id"))
    low = cut_lineage(ids.where("own").join(low_ids, "id", "left_semi").select("user", "id"))
    cand = (low.withColumnRenamed("user", "u1")
            .join(low.withColumnRenamed("user", "u2"), "id")
            .where(F.col("u1") < F.col("u2"))
            .select("u1", "u2").distinct())
    ids = ids.select("user", "id")
    n_ids = cut_lineage(ids.groupBy("user").agg(F.count(F.lit(1)).alias("n")))
    # pairs that are too few for the rule's count on one side alone need no look
    c = (cand.join(n_ids.select(F.col("user").alias("u1"), F.col("n").alias("n1")), "u1")
         .join(n_ids.select(F.col("user").alias("u2"), F.col("n").alias("n2")), "u2")
         .where(F.least("n1", "n2") >= min_shared))
    small_first = F.col("n1") <= F.col("n2")
    c = cut_lineage(c.select("u1", "u2",
                             F.when(small_first, F.col("u1")).otherwise(F.col("u2")).alias("s"),
                             F.when(small_first, F.col("u2")).otherwise(F.col("u1")).alias("o")))
    expanded = c.join(ids.select(F.col("user").alias("s"), "id"), "s")
    shared = expanded.join(ids.select(F.col("user").alias("o"), "id"), ["o", "id"], "left_semi")
    counted = shared.groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.where(F.col("cnt") >= min_shared).select(
        F.col("u1").alias("start_guid"), F.col("u2").alias("end_guid"))


def label_fraud_risk(users: DataFrame, labels: DataFrame, flag: str = "fraudMoneyTransfer",
                     comp: str = "wccId", **heavy) -> DataFrame:
    """fraudRisk = 1 for every member of a component holding a flagged user,
    else 0. The flagged components are a written partial aggregate joined back
    on the component key, the members of giant components over salts."""
    u = cut_lineage(users.join(labels, "guid"))
    return (join_back(u, [comp], "left", keep=F.col("__risk") == 1, __risk=F.max(F.col(flag)), **heavy)
            .withColumn("fraudRisk", F.coalesce(F.col("__risk"), F.lit(0)).cast("int"))
            .drop("__risk"))
