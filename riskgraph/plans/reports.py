"""Report queries of the analysis: each returns a DataFrame whose column
names are the oracle's. Aggregates that feed a share of a grand total are
combined with a window over the already aggregated (tiny) result, never
with a cross join of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.functions.exprs import r3, r6, ratio, ratio_bucket, size_bin, uid8
from riskgraph.operators.joinback import join_back
from riskgraph.session import cut_lineage
from riskgraph.plans.pipeline import AVG_RISK_CUT, MIN_RISK_USERS, FraudPipeline

PERCENTILES = [0.5, 0.75, 0.9, 0.95, 0.99]
_PCT_NAMES = ["p50", "p75", "p90", "p95", "p99"]


def ratio_buckets(deg: DataFrame, label: str, num: str, out: str) -> DataFrame:
    """Identifiers of ``label`` with degree > 1 bucketed by ``num/degree``:
    (bucket, count, share of all such identifiers rounded to 3)."""
    d = deg.where((F.col("label") == label) & (F.col("degree") > 1))
    b = d.groupBy(ratio_bucket(num, "degree").alias(out)).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return b.select(out, "count", r3(F.col("count") / total).alias("percentCount")).orderBy(out)


def size_distribution(sizes: DataFrame, col: str, prefix: str = "", pct_digits: int | None = None) -> DataFrame:
    """count, min, max, mean and exact (interpolated) percentiles of a
    column. Spark's percentile keeps a value->count map, so its state is
    bounded by the number of distinct values, not by rows: integer sizes
    have few; a continuous score is rounded to ``pct_digits`` first, which
    bounds the map to 10**pct_digits + 1 entries at any scale."""
    aggs = [F.count(F.lit(1)).alias(f"{prefix}count"), r6(F.min(col)).alias(f"{prefix}min"),
            r6(F.max(col)).alias(f"{prefix}max"), r6(F.avg(col)).alias(f"{prefix}mean")]
    v = F.col(col) if pct_digits is None else F.round(F.col(col), pct_digits)
    aggs += [r6(F.percentile(v, p)).alias(f"{prefix}{n}") for p, n in zip(PERCENTILES, _PCT_NAMES)]
    return sizes.agg(*aggs)


def wcc_size_stats(p: FraudPipeline) -> DataFrame:
    comm = p.users_risk.groupBy("wccId").agg(
        F.count(F.lit(1)).alias("cSize"), F.sum("fraudRisk").cast("bigint").alias("cFraudSize"))
    return (comm.groupBy(size_bin("cSize").alias("componentSize"))
            .agg(F.count(F.lit(1)).alias("numberOfComponents"),
                 F.sum("cSize").cast("bigint").alias("totalUserCount"),
                 F.sum("cFraudSize").cast("bigint").alias("fraudUserCount"))
            .orderBy("componentSize"))


def community_report(users: DataFrame, col: str, top: int = 100) -> DataFrame:
    """Communities by flagged users: (community, cnt, flaggedCount,
    flaggedRatio), the ``top`` with most flagged users (ties: smaller id)."""
    c = users.groupBy(F.col(col).alias("community")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("fraudMoneyTransfer").cast("bigint").alias("flaggedCount"))
    c = c.withColumn("flaggedRatio", r6(ratio("flaggedCount", "cnt")))
    return c.orderBy(F.col("flaggedCount").desc(), F.col("community").asc()).limit(top)


def community_subgraph(p: FraudPipeline, labels: DataFrame, col: str, community=None) -> DataFrame:
    """The subgraph of one community that the member-pair pattern
    ``(u1)-[r1]->(n)<-[r2]-(u2)``, ``OPTIONAL (u1)-[:P2P]-(u2)`` draws,
    returned as its edges rather than as all member pairs (a hub identifier
    shared by many members would otherwise square):

    * ``kind='ID'``: member -> identifier edges (parallel edges counted) for
      identifiers reached by at least two member edges, i.e. the ``n`` of
      some pair of distinct edges;
    * ``kind='P2P'``: member -> member transfers (count and summed amount).

    ``community`` defaults to the community with most flagged users (ties:
    smaller id), chosen by a top-1 query. Output
    ``(kind, src, dst, edges, amount)`` with ids as strings.
    """
    members = labels.select("guid", F.col(col).alias("community"))
    if community is None:
        top = community_report(p.users.join(labels, "guid"), col, 1).select("community")
        members = members.join(top, "community", "left_semi")
    else:
        members = members.where(F.col("community") == community)
    m = members.select("guid")
    e = (p.id_edges.join(m.withColumnRenamed("guid", "start_guid"), "start_guid", "left_semi")
         .groupBy("start_guid", "end_label", "end_guid").agg(F.count(F.lit(1)).alias("edges")))
    ids = join_back(e, ["end_label", "end_guid"], keep=F.col("n") >= 2, n=F.sum("edges")).select(
        F.lit("ID").alias("kind"), F.col("start_guid").cast("string").alias("src"),
        F.col("end_guid").alias("dst"), "edges", F.lit(None).cast("double").alias("amount"))
    t = (p.p2p.join(m.withColumnRenamed("guid", "start_guid"), "start_guid", "left_semi")
         .join(m.withColumnRenamed("guid", "end_guid"), "end_guid", "left_semi")
         .groupBy("start_guid", "end_guid")
         .agg(F.count(F.lit(1)).alias("edges"), r6(F.sum("totalAmount")).alias("amount")))
    tr = t.select(F.lit("P2P").alias("kind"), F.col("start_guid").cast("string").alias("src"),
                  F.col("end_guid").cast("string").alias("dst"), "edges", "amount")
    return ids.unionByName(tr)


def p2p_flagged_share(p: FraudPipeline) -> DataFrame:
    """Share of flagged<->other money that involves a newly labelled risk
    user. One pass: both endpoint labels are joined to each transfer and two
    conditional sums taken; no row when there is no such transfer."""
    t = _labelled_transfers(p)
    f1, f2, r1, r2 = F.col("f1") == 1, F.col("f2") == 1, F.col("r1") == 1, F.col("r2") == 1
    one_flagged = (f1 & ~f2) | (f2 & ~f1)
    new_risk_other = (f1 & ~f2 & r2) | (f2 & ~f1 & r1)
    a = t.agg(F.sum(F.when(one_flagged, F.col("totalAmount")).otherwise(0.0)).alias("p2pTotal"),
              F.sum(F.when(new_risk_other, F.col("totalAmount"))).alias("riskTotal"),
              F.count_if(new_risk_other).alias("n"))
    return a.where(F.col("n") > 0).select(r3(F.try_divide("riskTotal", "p2pTotal")).alias("p"))


def p2p_total_share(p: FraudPipeline, count_once: bool = False) -> DataFrame:
    """Share of all transfer money with a newly labelled risk user at either
    end. By default a transfer between two such users counts twice in the
    numerator (undirected match per end); ``count_once`` counts it once."""
    t = _labelled_transfers(p)
    new1 = ((F.col("r1") == 1) & (F.col("f1") == 0)).cast("int")
    new2 = ((F.col("r2") == 1) & (F.col("f2") == 0)).cast("int")
    loop = F.col("start_guid") == F.col("end_guid")
    mult = F.when(loop, new1).otherwise(F.greatest(new1, new2) if count_once else (new1 + new2))
    a = t.agg(F.sum("totalAmount").alias("p2pTotal"),
              F.sum(F.when(mult > 0, F.col("totalAmount") * mult)).alias("riskTotal"),
              F.count_if(mult > 0).alias("n"))
    return a.where(F.col("n") > 0).select(r3(F.try_divide("riskTotal", "p2pTotal")).alias("p"))


def _labelled_transfers(p: FraudPipeline) -> DataFrame:
    u = p.users_risk.select("guid", "fraudMoneyTransfer", "fraudRisk")
    return (p.p2p.select("start_guid", "end_guid", "totalAmount")
            .join(u.select(F.col("guid").alias("start_guid"), F.col("fraudMoneyTransfer").alias("f1"),
                           F.col("fraudRisk").alias("r1")), "start_guid")
            .join(u.select(F.col("guid").alias("end_guid"), F.col("fraudMoneyTransfer").alias("f2"),
                           F.col("fraudRisk").alias("r2")), "end_guid"))


def weighted_degree_top(p: FraudPipeline, top: int = 10, key: str = "uid8") -> DataFrame:
    """Non-risk users ranked by the summed fraudRiskRatio of their edges to
    identifiers that touch a risk user; average >= 0.25; top 10. Users are
    grouped by their 8-character display id (``key="uid8"``, as the
    analysis does, which merges colliding prefixes) or by ``guid``."""
    e = (p.risk_edges.where((F.col("fraudRiskDegree") > 0) & (F.col("fraudRisk") == 0))
         .withColumn("fraudRiskRatio", ratio("fraudRiskDegree", "degree")))
    if key == "uid8":
        # real ids are 128-bit strings: their first 8 characters; integer
        # test ids are first turned into a string id with md5
        is_str = dict(e.dtypes)["start_guid"] == "string"
        k = F.left(F.col("start_guid"), F.lit(8)) if is_str else uid8("start_guid")
    else:
        k = F.col("start_guid").cast("string")
    g = e.groupBy(k.alias("uid")).agg(
        F.sum("fraudRiskRatio").alias("totalIdFraudRisk"),
        F.count(F.lit(1)).alias("numberFraudRiskIds"))
    g = g.withColumn("averageFraudIdRisk", F.col("totalIdFraudRisk") / F.col("numberFraudRiskIds"))
    g = g.where(F.col("averageFraudIdRisk") >= AVG_RISK_CUT)
    return (g.orderBy(F.round("totalIdFraudRisk", 9).desc(), F.col("uid").asc()).limit(top)
            .select("uid", r6("totalIdFraudRisk").alias("totalIdFraudRisk"), "numberFraudRiskIds",
                    r6("averageFraudIdRisk").alias("averageFraudIdRisk")))


def similar_to_communities(p: FraudPipeline, listed: bool = False) -> DataFrame:
    """Non-risk users similar to members of risk communities with more than
    two risk users: a row for each user and community, with the score that comes
    from it, the user's total score and number of communities. ``listed`` gives
    the report's form instead, a row a user with the sorted list of communities
    as one string (which grows with the user's communities)."""
    risk = p.users_risk.where(F.col("fraudRisk") == 1).select("guid", "wccId")
    f = (join_back(risk, ["wccId"], keep=F.col("numberOfUsers") > MIN_RISK_USERS, numberOfUsers=F.count(F.lit(1)))
         .select(F.col("guid").alias("node1"), "wccId"))
    non_risk = p.users_risk.where(F.col("fraudRisk") == 0).select(F.col("guid").alias("node2"))
    s = p.similarity.join(f, "node1").join(non_risk, "node2", "left_semi")
    per = cut_lineage(s.groupBy(F.col("node2").alias("userId"), F.col("wccId").alias("communityId"))
                      .agg(F.sum("similarity").alias("score")))
    if listed:
        return (per.groupBy("userId").agg(
            r6(F.sum("score")).alias("totalScore"),
            F.array_join(F.sort_array(F.collect_list(F.col("communityId").cast("string"))), ",")
            .alias("closeToCommunityIds")).orderBy(F.col("totalScore").desc(), F.col("userId")))
    return (join_back(per, ["userId"], totalScore=F.sum("score"), numberOfCommunities=F.count(F.lit(1)))
            .select("userId", "communityId", r6("score").alias("score"), r6("totalScore").alias("totalScore"),
                    "numberOfCommunities")
            .orderBy(F.col("totalScore").desc(), F.col("userId"), F.col("communityId")))


def community_size_hist(p: FraudPipeline, bins_per_decade: int = 10, max_size: int = 1000) -> DataFrame:
    """Histogram of community sizes below ``max_size`` on a log10 axis."""
    sizes = p.wcc_labels.groupBy("wccId").agg(F.count(F.lit(1)).alias("community_size")) \
        .where(F.col("community_size") < max_size)
    b = F.floor(F.log10(F.col("community_size")) * bins_per_decade).cast("int")
    return (sizes.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("numberOfCommunities"),
                 F.min("community_size").alias("minSize"), F.max("community_size").alias("maxSize"))
            .orderBy("bin"))


def interesting_users(p: FraudPipeline, lo: int = 10, hi: int = 1000) -> DataFrame:
    cf = p.community_features()
    return cf.where((F.col("communitySize") > lo) & (F.col("communitySize") < hi)) \
        .select("guid", "wccId", "communitySize")
