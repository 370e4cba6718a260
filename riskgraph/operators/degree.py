"""Degree centrality (plain, weighted, restricted) and the identifier degree
report. Each is one partial aggregate over the edge table plus a join with
the node table so that nodes without edges get 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import ratio


def degree(nodes: DataFrame, edges: DataFrame, out: str = "degree",
           weight: str | None = None) -> DataFrame:
    """Out-degree of every node over projected edges ``(src, dst, w)``.

    Parallel edges count; with ``weight`` the sum of positive weights is
    returned instead. Nodes without edges get 0 (left join, ``coalesce``).
    """
    if weight:
        agg = (edges.where(F.col(weight) > 0).groupBy("src")
               .agg(F.sum(weight).cast("double").alias(out)))
        zero = F.lit(0.0)
    else:
        agg = edges.groupBy("src").agg(F.count(F.lit(1)).alias(out))
        zero = F.lit(0).cast("bigint")
    return (nodes.select("guid")
            .join(agg.withColumnRenamed("src", "guid"), "guid", "left")
            .select("guid", F.coalesce(F.col(out), zero).alias(out)))


def identifier_degrees(id_edges: DataFrame, users: DataFrame, subsets: dict[str, str] | None = None,
                       identifiers: DataFrame | None = None) -> DataFrame:
    """Degree of each Card/Device/IP w.r.t. all users and user subsets.

    ``id_edges``: ``(start_guid, end_guid, rel, end_label)``; ``users`` has
    ``guid`` and one 0/1 column per subset; ``subsets`` maps an output name
    (e.g. ``flaggedDegree``) to that column. One join on the user key and one
    ``groupBy(identifier)`` with conditional sums compute every degree in a
    single pass; the aggregate is partial, so hub identifiers combine
    map-side. ``identifiers`` (``label, guid``), when given, adds
    edge-less identifiers with 0.
    """
    subsets = subsets or {}
    u = users.select(F.col("guid").alias("start_guid"), *[F.col(c) for c in set(subsets.values())])
    j = id_edges.join(u, "start_guid")
    aggs = [F.count(F.lit(1)).alias("degree")]
    aggs += [F.sum(F.col(src).cast("bigint")).alias(name) for name, src in subsets.items()]
    d = j.groupBy(F.col("end_label").alias("label"), F.col("end_guid").alias("guid")).agg(*aggs)
    if identifiers is not None:
        d = identifiers.join(d, ["label", "guid"], "left")
        d = d.select("label", "guid", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
                                        for c in ["degree", *subsets]])
    return d


def with_ratio(deg: DataFrame, num: str, den: str = "degree", out: str | None = None) -> DataFrame:
    """Add ``num/den`` (null when ``den`` is 0)."""
    return deg.withColumn(out or num.replace("Degree", "Ratio"), ratio(num, den))


def user_id_degrees(users: DataFrame, id_edges: DataFrame) -> DataFrame:
    """cardDegree, deviceDegree, ipDegree of every user in one pass: count of
    HAS_CC / USED / HAS_IP edges (parallel edges count), 0 when none."""
    cnt = id_edges.groupBy(F.col("start_guid").alias("guid")).agg(
        F.count_if(F.col("rel") == "HAS_CC").alias("cardDegree"),
        F.count_if(F.col("rel") == "USED").alias("deviceDegree"),
        F.count_if(F.col("rel") == "HAS_IP").alias("ipDegree"),
    )
    cols = ["cardDegree", "deviceDegree", "ipDegree"]
    return (users.select("guid").join(cnt, "guid", "left")
            .select("guid", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in cols]))


def p2p_degrees(users: DataFrame, p2p: DataFrame) -> DataFrame:
    """Sent/received degree and amount-weighted degree on the P2P projection
    with parallel transfers summed (one edge per ordered pair).

    Both directions are emitted into one frame and grouped once by user."""
    pairs = p2p.groupBy("start_guid", "end_guid").agg(F.sum("totalAmount").alias("amt"))
    sent = pairs.select(F.col("start_guid").alias("guid"), F.lit(1).alias("s"), F.lit(0).alias("r"),
                        F.col("amt").alias("sw"), F.lit(0.0).alias("rw"))
    recv = pairs.select(F.col("end_guid").alias("guid"), F.lit(0).alias("s"), F.lit(1).alias("r"),
                        F.lit(0.0).alias("sw"), F.col("amt").alias("rw"))
    agg = sent.unionByName(recv).groupBy("guid").agg(
        F.sum("s").cast("bigint").alias("p2pSentDegree"),
        F.sum("r").cast("bigint").alias("p2pReceivedDegree"),
        F.sum(F.when(F.col("sw") > 0, F.col("sw")).otherwise(0.0)).alias("p2pSentWeightedDegree"),
        F.sum(F.when(F.col("rw") > 0, F.col("rw")).otherwise(0.0)).alias("p2pReceivedWeightedDegree"),
    )
    return (users.select("guid").join(agg, "guid", "left").select(
        "guid",
        F.coalesce("p2pSentDegree", F.lit(0).cast("bigint")).alias("p2pSentDegree"),
        F.coalesce("p2pReceivedDegree", F.lit(0).cast("bigint")).alias("p2pReceivedDegree"),
        F.coalesce("p2pSentWeightedDegree", F.lit(0.0)).alias("p2pSentWeightedDegree"),
        F.coalesce("p2pReceivedWeightedDegree", F.lit(0.0)).alias("p2pReceivedWeightedDegree"),
    ))


def undirected_degree(users: DataFrame, pairs: DataFrame, out: str) -> DataFrame:
    """Degree on an undirected projection of a pair table
    ``(start_guid, end_guid)``: each pair counts once for each end."""
    ends = (pairs.select(F.col("start_guid").alias("guid"))
            .unionByName(pairs.where(F.col("start_guid") != F.col("end_guid"))
                         .select(F.col("end_guid").alias("guid"))))
    cnt = ends.groupBy("guid").agg(F.count(F.lit(1)).alias(out))
    return (users.select("guid").join(cnt, "guid", "left")
            .select("guid", F.coalesce(F.col(out), F.lit(0).cast("bigint")).alias(out)))


def directed_degree(users: DataFrame, pairs: DataFrame, out: str, reverse: bool = False) -> DataFrame:
    """Out-degree (or in-degree with ``reverse``) on a pair table."""
    key = "end_guid" if reverse else "start_guid"
    cnt = pairs.groupBy(F.col(key).alias("guid")).agg(F.count(F.lit(1)).alias(out))
    return (users.select("guid").join(cnt, "guid", "left")
            .select("guid", F.coalesce(F.col(out), F.lit(0).cast("bigint")).alias(out)))
