"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the graph overlay, so its
work grows with them. Column names equal the oracle SQL's."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.exprs import r6
from riskgraph.operators import degree as deg
from riskgraph.operators import louvain as louvain_op
from riskgraph.operators.graph import NATURAL, REVERSE, UNDIRECTED, orient, project, projection_counts
from riskgraph.plans import metrics, model, reports
from riskgraph.plans.pipeline import pipeline_for
from riskgraph.session import scratch_dir
from riskgraph.sources import files, sinks
from riskgraph.sources.loader import load_graph
from riskgraph.sources.mergestore import MergeStore
from riskgraph.sources.overlay import _read, overlay_p2p, overlay_tables


def _p(spark, sf):
    return pipeline_for(spark, sf)


# ---- milestone 1 -----------------------------------------------------
def identifier_degrees(spark, sf):
    return _p(spark, sf).id_degrees()


def id_ratios(spark, sf):
    d = _p(spark, sf).id_ratios()
    return d.select("label", "guid", "degree", "flaggedDegree", r6("flaggedRatio").alias("flaggedRatio"))


def ratio_buckets_card_flagged(spark, sf):
    return reports.ratio_buckets(_p(spark, sf).id_degrees(), "Card", "flaggedDegree", "flaggedUserRatio")


def ratio_buckets_device_flagged(spark, sf):
    return reports.ratio_buckets(_p(spark, sf).id_degrees(), "Device", "flaggedDegree", "flaggedUserRatio")


# ---- milestone 2: sources, sinks, counts -----------------------------
_KINDS = {"cards": "node", "device": "node", "ip": "node", "user": "node",
          "has_cc": "edge", "used": "edge", "has_ip": "edge", "p2p": "edge", "referred": "edge"}


_WRITTEN: dict = {}


def _written(spark, sf) -> str:
    """The folder with the nine tables as files, written once a session."""
    key = (spark, sf.rstrip("/"))
    if key not in _WRITTEN:
        folder = scratch_dir(spark, f"loaded/{uuid.uuid4().hex}")
        for name, df in overlay_tables(spark, sf, _p(spark, sf).g).items():
            files.write_table(df, folder, name)
        _WRITTEN[key] = folder
    return _WRITTEN[key]


def _tables(spark, sf) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{_written(spark, sf)}/{name}.parquet") for name in _KINDS}


def row_counts(spark, sf):
    return files.row_counts(_tables(spark, sf))


def load_totals(spark, sf):
    return files.load_totals(_tables(spark, sf), _KINDS)


def loaded_graph_counts(spark, sf):
    """Nodes per label and edges per type of the graph that the loader builds
    from the files: discovered, nodes first, edges matched to both ends."""
    g = load_graph(spark, _written(spark, sf), check_keys=True)
    parts = [df.select(F.lit(kind).alias("kind"), F.lit(name).alias("name"))
             for kind, all_ in (("node", g.nodes), ("edge", g.edges)) for name, df in all_.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("count"))


def _user_batch(spark, sf) -> DataFrame:
    """A second batch of user rows derived from all orders: several rows
    per key, new keys for odd orders, nulls for open orders."""
    o = _read(spark, sf, "orders")
    return o.select(
        (F.col("o_custkey") + (F.col("o_orderkey") % 2) * 1000000).alias("guid"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("fraudMoneyTransfer"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice")).alias("moneyTransferErrorCancelAmount"),
        F.col("o_orderdate").alias("lastOrderDate"),
        F.col("o_orderkey").alias("_seq"),
    )


def node_merge_last_wins(spark, sf):
    b = _user_batch(spark, sf)
    return sinks.last_row_per_key(b, "guid", ["lastOrderDate", "_seq"]).drop("_seq")


def node_upsert(spark, sf):
    users = _p(spark, sf).users
    return sinks.merge_nodes(users, _user_batch(spark, sf), ["lastOrderDate", "_seq"], helpers=("_seq",))


def node_merge_epochs(spark, sf):
    """The user batch in three epochs, merged by the store: keys, last values."""
    store = MergeStore(spark, scratch_dir(spark, f"store/{uuid.uuid4().hex}"), ["guid"], ["lastOrderDate", "_seq"],
                       buckets=8)
    batch = _user_batch(spark, sf)
    for epoch in range(3):
        part = batch.where(F.col("_seq") % 3 == epoch)
        # the second batch knows nothing of the error amount
        store.write(part.drop("moneyTransferErrorCancelAmount") if epoch == 1 else part, epoch)
        if epoch == 1:
            store.compact()
    return store.read().drop("_seq")


def node_key_violations(spark, sf):
    users = _p(spark, sf).users.select("guid")
    return sinks.key_violations(users.unionByName(_user_batch(spark, sf).select("guid")))


def edge_match_append(spark, sf):
    users = _p(spark, sf).users
    return sinks.attach_edges(overlay_p2p(spark, sf), users, users,
                              ["totalAmount", "transactionDateTime"])


def edge_merge_last_wins(spark, sf):
    users = _p(spark, sf).users
    m = sinks.merge_edges(overlay_p2p(spark, sf), users, users, ["transactionDateTime", "totalAmount", "_order"])
    return m.select("start_guid", "end_guid", "totalAmount", "transactionDateTime")


def edge_label_pairs(spark, sf):
    t = _tables(spark, sf)
    parts = [sinks.endpoint_labels(t[name]).select(F.lit(name).alias("tableName"), "start_label", "end_label")
             for name in ("has_cc", "used", "has_ip", "p2p", "referred")]
    return reduce(DataFrame.unionByName, parts)


def label_counts(spark, sf):
    g = _p(spark, sf).g
    parts = [g.nodes[lbl].select(F.lit(lbl).alias("label")) for lbl in ("User", "Card", "Device", "IP")]
    return reduce(DataFrame.unionByName, parts).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


def reltype_counts(spark, sf):
    g = _p(spark, sf).g
    ids = g.identifier_edges().groupBy(F.col("rel").alias("type")).agg(F.count(F.lit(1)).alias("count"))
    other = (g.edges["P2P"].select(F.lit("P2P").alias("type"))
             .unionByName(g.edges["REFERRED"].select(F.lit("REFERRED").alias("type")))
             .groupBy("type").agg(F.count(F.lit(1)).alias("count")))
    return ids.unionByName(other)


def flag_distribution(spark, sf):
    return _p(spark, sf).users.groupBy("fraudMoneyTransfer").agg(F.count(F.lit(1)).alias("cnt"))


def flagged_users(spark, sf):
    return _p(spark, sf).users.where(F.col("fraudMoneyTransfer") == 1).select("guid")


def unwind_range(spark, sf):
    """UNWIND range(1, n): one row per user and number 1..cardDegree."""
    d = deg.user_id_degrees(_p(spark, sf).users, _p(spark, sf).id_edges)
    return d.where(F.col("cardDegree") > 0).select(
        "guid", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("cardDegree"))).alias("x"))


def projection_orientations(spark, sf):
    p2p = _p(spark, sf).p2p
    parts = [orient(p2p, o, "totalAmount").select(F.lit(o).alias("orientation"), "src", "dst", r6("w").alias("w"))
             for o in (NATURAL, REVERSE, UNDIRECTED)]
    return reduce(DataFrame.unionByName, parts)


def projection_sum(spark, sf):
    p2p = _p(spark, sf).p2p
    pr = project({"P2P": p2p}, {"P2P": {"orientation": NATURAL, "aggregation": "SUM", "weight": "totalAmount"}})
    return pr.select("src", "dst", r6("w").alias("totalAmount"))


def projection_counts_q(spark, sf):
    p = _p(spark, sf)
    g = p.g
    all_nodes = reduce(DataFrame.unionByName, [g.nodes[lbl].select(F.col("guid").cast("string").alias("guid"))
                                               for lbl in ("User", "Card", "Device", "IP")])
    id_proj = project({t: g.edges[t] for t in ("HAS_CC", "HAS_IP", "USED")},
                      {t: {"orientation": REVERSE} for t in ("HAS_CC", "HAS_IP", "USED")})
    comm_nodes = reduce(DataFrame.unionByName, [g.nodes[lbl].select(F.col("guid").cast("string").alias("guid"))
                                                for lbl in ("User", "Card", "Device")])
    comm = project({t: g.edges[t] for t in ("HAS_CC", "USED", "P2P")},
                   {"HAS_CC": {"orientation": UNDIRECTED}, "USED": {"orientation": UNDIRECTED},
                    "P2P": {"orientation": NATURAL, "aggregation": "SINGLE"}})
    sim_edges = p.fraud_shared_id_edges()
    sim_nodes = (p.users.select(F.col("guid").cast("string").alias("guid"))
                 .unionByName(p.risk_touched_ids().select(F.col("guid").cast("string").alias("guid"))))
    return (projection_counts("id-projection", all_nodes, id_proj)
            .unionByName(projection_counts("comm-projection", comm_nodes, comm))
            .unionByName(projection_counts("similarity-projection", sim_nodes, sim_edges)))


def user_id_degrees(spark, sf):
    p = _p(spark, sf)
    return deg.user_id_degrees(p.users, p.id_edges)


def p2p_degrees(spark, sf):
    p = _p(spark, sf)
    return deg.p2p_degrees(p.users, p.p2p).select("guid", "p2pSentDegree", "p2pReceivedDegree")


def p2p_weighted_degrees(spark, sf):
    p = _p(spark, sf)
    d = deg.p2p_degrees(p.users, p.p2p)
    return d.select("guid", r6("p2pSentWeightedDegree").alias("p2pSentWeightedDegree"),
                    r6("p2pReceivedWeightedDegree").alias("p2pReceivedWeightedDegree"))


# ---- milestone 3: entity resolution -------------------------------------
def er_p2p_shared_card(spark, sf):
    return _p(spark, sf).p2p_shared_card()


def er_shared_ids(spark, sf):
    return _p(spark, sf).shared_ids()


def er_counts(spark, sf):
    p = _p(spark, sf)
    a = p.p2p_shared_card().agg(F.lit("P2P_WITH_SHARED_CARD").alias("rule"), F.count(F.lit(1)).alias("pairs"))
    b = p.shared_ids().agg(F.lit("SHARED_IDS").alias("rule"), F.count(F.lit(1)).alias("pairs"))
    return a.unionByName(b)


def shared_ids_degree(spark, sf):
    p = _p(spark, sf)
    return deg.undirected_degree(p.users, p.shared_ids(), "sharedIdsDegree")


# ---- milestone 4: components -------------------------------------------
def wcc(spark, sf):
    return _p(spark, sf).wcc_labels


def wcc_distribution(spark, sf):
    sizes = _p(spark, sf).wcc_labels.groupBy("wccId").agg(F.count(F.lit(1)).alias("size"))
    return reports.size_distribution(sizes, "size").withColumnRenamed("count", "componentCount")


def wcc_size_stats(spark, sf):
    return reports.wcc_size_stats(_p(spark, sf))


def fraud_risk_labels(spark, sf):
    return _p(spark, sf).users_risk.select("guid", "wccId", "fraudRisk")


def community_report(spark, sf):
    return reports.community_report(_p(spark, sf).users_risk, "wccId", 100)


def community_subgraph(spark, sf):
    p = _p(spark, sf)
    return reports.community_subgraph(p, p.wcc_labels, "wccId")


def community_features(spark, sf):
    return _p(spark, sf).community_features()


def community_size_hist(spark, sf):
    return reports.community_size_hist(_p(spark, sf))


def interesting_users(spark, sf):
    return reports.interesting_users(_p(spark, sf))


# ---- milestone 5: impact and recommendation -------------------------------
def p2p_flagged_share(spark, sf):
    return reports.p2p_flagged_share(_p(spark, sf))


def p2p_total_share(spark, sf):
    return reports.p2p_total_share(_p(spark, sf))


def ratio_buckets_card_risk(spark, sf):
    return reports.ratio_buckets(_p(spark, sf).risk_degrees(), "Card", "fraudRiskDegree", "fraudRiskRatio")


def ratio_buckets_device_risk(spark, sf):
    return reports.ratio_buckets(_p(spark, sf).risk_degrees(), "Device", "fraudRiskDegree", "fraudRiskRatio")


def weighted_degree_top(spark, sf):
    return reports.weighted_degree_top(_p(spark, sf))


def fraud_shared_ids(spark, sf):
    e = _p(spark, sf).fraud_shared_id_edges()
    return e.select("start_guid", "end_guid", "end_label", r6("inverseDegreeWeight").alias("inverseDegreeWeight"))


def node_similarity(spark, sf):
    s = _p(spark, sf).similarity
    return s.select("node1", "node2", r6("similarity").alias("similarity"))


def similarity_distribution(spark, sf):
    s = _p(spark, sf).similarity
    return (reports.size_distribution(s, "similarity", pct_digits=6)
            .withColumnRenamed("count", "relationshipsWritten"))


def similar_to_communities(spark, sf):
    return reports.similar_to_communities(_p(spark, sf))


# ---- milestone 6: PageRank and features --------------------------------
def _pr(variant):
    def q(spark, sf):
        return _p(spark, sf).pagerank(variant).select("guid", pr6("pagerank").alias("pagerank"))
    q.__name__ = variant
    return q


# The analysis' feature names.
FEATURES_10 = ["sharedIdsDegree", "p2pSharedCardPageRank", "p2pSentPageRank", "p2pReceivedWeightedPageRank",
               "p2pReceivedWeightedDegree", "ipDegree", "cardDegree", "deviceDegree", "communitySize",
               "partOfCommunity"]

FEATURE_COLUMNS = [
    "sharedIdsDegree", "p2pSharedCardPageRank", "p2pSharedCardDegree", "p2pReversedSharedCardPageRank",
    "p2pReversedSharedCardDegree", "p2pSentPageRank", "p2pSentWeightedPageRank", "p2pSentWeightedDegree",
    "p2pSentDegree", "p2pReceivedPageRank", "p2pReceivedWeightedPageRank", "p2pReceivedWeightedDegree",
    "p2pReceivedDegree", "cardDegree", "deviceDegree", "ipDegree", "communitySize", "partOfCommunity",
]
_DOUBLE_FEATURES = {c for c in FEATURE_COLUMNS if "PageRank" in c or "Weighted" in c}


def pr6(c):
    """PageRank sums land exactly on a 6th-decimal half more often than
    chance (0.15 + 0.85 * short fractions); a 1e-9 nudge keeps the rounding
    stable against last-bit summation-order noise. The oracle does the same."""
    return F.round(F.col(c) + F.lit(1e-9), 6)


def _fmt(c):
    if "PageRank" in c:
        return pr6(c).alias(c)
    return r6(c).alias(c) if c in _DOUBLE_FEATURES else F.col(c)


def user_feature_table(spark, sf):
    t = _p(spark, sf).features
    cols = [_fmt(c) for c in FEATURE_COLUMNS]
    return t.select("guid", "fraudMoneyTransfer", "wccId", "fraudRisk", *cols)


def ml_training_set(spark, sf):
    t = _p(spark, sf).features
    cols = [_fmt(c) for c in FEATURES_10]
    return t.select("guid", *cols, (F.col("fraudRisk") - F.col("fraudMoneyTransfer")).alias("label"))


# ---- milestone 7: metrics on a fixed score, forest ----------------------
def accuracy(spark, sf):
    return metrics.accuracy(_p(spark, sf).fixed_predictions())


def confusion_matrix(spark, sf):
    return metrics.confusion(_p(spark, sf).fixed_predictions())


def roc_points(spark, sf):
    return metrics.roc_points(_p(spark, sf).fixed_score())


def pr_points(spark, sf):
    return metrics.pr_points(_p(spark, sf).fixed_score())


def score_write_back(spark, sf):
    p = _p(spark, sf)
    short = (p.fixed_score().where((F.col("score") > 0.88) & (F.col("label") == 0))
             .select("guid", F.col("score").alias("predictedProbability")))
    return sinks.write_back(p.users.select("guid"), short, "predictedProbability")


def fixed_rule(df):
    """A rule on whole numbers in place of a model, for the oracle."""
    hit = 2 * F.col("communitySize") + 3 * F.col("sharedIdsDegree") - F.col("cardDegree") - F.col("deviceDegree") >= 25
    return df.withColumn("prediction", hit.cast("int"))


FIXED_RULE_COLUMNS = ["sharedIdsDegree", "communitySize", "cardDegree", "deviceDegree", "ipDegree"]


def permutation_importance_fixed(spark, sf):
    """Permutation importance of ``fixed_rule`` over all users."""
    f = _p(spark, sf).features.select("guid", *FIXED_RULE_COLUMNS,
                                      (F.col("fraudRisk") - F.col("fraudMoneyTransfer")).alias("label"))
    return model.permutation_importance(fixed_rule, f, FIXED_RULE_COLUMNS)


def rf_predictions(spark, sf):
    pr = _p(spark, sf).rf_predictions
    return pr.select("guid", "label", F.col("prediction").cast("int").alias("prediction"),
                     r6("probability").alias("probability"))


def rf_accuracy(spark, sf):
    return metrics.accuracy(_p(spark, sf).rf_predictions)


def rf_confusion_matrix(spark, sf):
    return metrics.confusion(_p(spark, sf).rf_predictions)


def rf_roc_points(spark, sf):
    return metrics.roc_points(_p(spark, sf).rf_predictions, score="probability")


def rf_pr_points(spark, sf):
    return metrics.pr_points(_p(spark, sf).rf_predictions, score="probability")


def permutation_importance(spark, sf):
    return _p(spark, sf).importance("train")


def rf_shortlist(spark, sf):
    p = _p(spark, sf)
    s = model.shortlist(p.rf_predictions).select("guid", "probability")
    return (s.join(p.community_features(), "guid")
            .select("guid", "wccId", "communitySize", r6("probability").alias("predictedProbability")))


def rf_write_back(spark, sf):
    p = _p(spark, sf)
    s = model.shortlist(p.rf_predictions).select("guid", r6("probability").alias("predictedProbability"))
    return sinks.write_back(p.users.select("guid"), s, "predictedProbability")


# ---- milestone 8: Louvain ---------------------------------------------------
def louvain(spark, sf):
    return _p(spark, sf).louvain_users()


def louvain_modularity(spark, sf):
    """Modularity of a given partition of the Louvain graph: households of 15
    users, identifiers with their smallest user."""
    p = _p(spark, sf)
    _, edges = p.louvain_graph()
    fifteen = lambda c: F.floor(F.col(c).cast("bigint") / 15).cast("bigint").alias("community")
    users = p.node_ids.where(F.col("label") == "User").select(F.col("id").alias("node"), fifteen("guid"))
    ids = (p.owned_id_edges.groupBy(F.col("end_id").alias("node"))
           .agg(F.min("start_guid").alias("first")).select("node", fifteen("first")))
    q = louvain_op.modularity_table(edges, users.unionByName(ids))
    return q.select(r6("weight").alias("weight"), "communities", r6(F.col("modularity") + F.lit(1e-12)).alias("modularity"))


def louvain_first_moves(spark, sf):
    """The best first move of every node, from singletons."""
    p = _p(spark, sf)
    names = p.node_ids
    moves = louvain_op.first_moves(p.louvain_graph()[1]).select(F.col("node").alias("id"), "target")
    target = names.select(F.col("id").alias("target"), F.col("label").alias("targetLabel"), F.col("guid").alias("targetGuid"))
    return moves.join(names, "id").join(target, "target").select("label", "guid", "targetLabel", "targetGuid")


def louvain_report(spark, sf):
    p = _p(spark, sf)
    users = p.users.join(louvain(spark, sf), "guid")
    return reports.community_report(users, "louvainCommunityId", 100)


def louvain_subgraph(spark, sf):
    p = _p(spark, sf)
    return reports.community_subgraph(p, louvain(spark, sf), "louvainCommunityId")


# ---- streaming ---------------------------------------------------------------
def stream_identifier_degrees(spark, sf):
    from riskgraph.streaming.ingest import streamed_identifier_degrees
    return streamed_identifier_degrees(spark, sf)


def stream_edge_merge(spark, sf):
    from riskgraph.streaming.ingest import streamed_edge_merge
    return streamed_edge_merge(spark, sf)


QUERIES = {
    "identifier_degrees": identifier_degrees,
    "id_ratios": id_ratios,
    "ratio_buckets_card_flagged": ratio_buckets_card_flagged,
    "row_counts": row_counts,
    "load_totals": load_totals,
    "loaded_graph_counts": loaded_graph_counts,
    "node_upsert": node_upsert,
    "node_key_violations": node_key_violations,
    "node_merge_last_wins": node_merge_last_wins,
    "node_merge_epochs": node_merge_epochs,
    "edge_match_append": edge_match_append,
    "edge_merge_last_wins": edge_merge_last_wins,
    "edge_label_pairs": edge_label_pairs,
    "label_counts": label_counts,
    "reltype_counts": reltype_counts,
    "flag_distribution": flag_distribution,
    "flagged_users": flagged_users,
    "unwind_range": unwind_range,
    "projection_orientations": projection_orientations,
    "projection_sum": projection_sum,
    "projection_counts": projection_counts_q,
    "user_id_degrees": user_id_degrees,
    "p2p_degrees": p2p_degrees,
    "p2p_weighted_degrees": p2p_weighted_degrees,
    "ratio_buckets_device_flagged": ratio_buckets_device_flagged,
    "er_p2p_shared_card": er_p2p_shared_card,
    "er_shared_ids": er_shared_ids,
    "er_counts": er_counts,
    "shared_ids_degree": shared_ids_degree,
    "wcc": wcc,
    "wcc_distribution": wcc_distribution,
    "wcc_size_stats": wcc_size_stats,
    "fraud_risk_labels": fraud_risk_labels,
    "community_report": community_report,
    "community_subgraph": community_subgraph,
    "community_features": community_features,
    "community_size_hist": community_size_hist,
    "interesting_users": interesting_users,
    "p2p_flagged_share": p2p_flagged_share,
    "p2p_total_share": p2p_total_share,
    "ratio_buckets_card_risk": ratio_buckets_card_risk,
    "ratio_buckets_device_risk": ratio_buckets_device_risk,
    "weighted_degree_top": weighted_degree_top,
    "fraud_shared_ids": fraud_shared_ids,
    "node_similarity": node_similarity,
    "similarity_distribution": similarity_distribution,
    "similar_to_communities": similar_to_communities,
    "pagerank_p2p_sent": _pr("pagerank_p2p_sent"),
    "pagerank_p2p_received": _pr("pagerank_p2p_received"),
    "pagerank_shared_card": _pr("pagerank_shared_card"),
    "pagerank_shared_card_reverse": _pr("pagerank_shared_card_reverse"),
    "pagerank_weighted_p2p_sent": _pr("pagerank_weighted_p2p_sent"),
    "pagerank_weighted_p2p_received": _pr("pagerank_weighted_p2p_received"),
    "user_feature_table": user_feature_table,
    "ml_training_set": ml_training_set,
    "accuracy": accuracy,
    "confusion_matrix": confusion_matrix,
    "roc_points": roc_points,
    "pr_points": pr_points,
    "score_write_back": score_write_back,
    "permutation_importance_fixed": permutation_importance_fixed,
    "rf_predictions": rf_predictions,
    "rf_accuracy": rf_accuracy,
    "rf_confusion_matrix": rf_confusion_matrix,
    "rf_roc_points": rf_roc_points,
    "rf_pr_points": rf_pr_points,
    "permutation_importance": permutation_importance,
    "rf_shortlist": rf_shortlist,
    "rf_write_back": rf_write_back,
    "louvain": louvain,
    "louvain_modularity": louvain_modularity,
    "louvain_first_moves": louvain_first_moves,
    "louvain_report": louvain_report,
    "louvain_subgraph": louvain_subgraph,
    "stream_identifier_degrees": stream_identifier_degrees,
    "stream_edge_merge": stream_edge_merge,
}
