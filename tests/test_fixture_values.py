"""Expected values of FIXTURES.md §4 on the smallest test tables."""

from pyspark.sql import functions as F

from riskgraph.plans.pipeline import pipeline_for
from riskgraph.plans.queries import QUERIES as Q
from tests.conftest import SF_SMALL as SF


def test_fixture_values_sf0001(spark):
    p = pipeline_for(spark, SF)
    assert p.users.count() == 150
    e = {t: p.g.edges[t].count() for t in ("HAS_CC", "USED", "HAS_IP", "P2P", "REFERRED")}
    assert e == {"HAS_CC": 1968, "USED": 1962, "HAS_IP": 2070, "P2P": 485, "REFERRED": 49}
    assert {r.label: r["count"] for r in Q["label_counts"](spark, SF).collect()} == \
        {"User": 150, "Card": 200, "Device": 153, "IP": 10}
    assert Q["flagged_users"](spark, SF).count() == 3
    er = {r.rule: r.pairs for r in Q["er_counts"](spark, SF).collect()}
    assert er == {"P2P_WITH_SHARED_CARD": 86, "SHARED_IDS": 286}
    sizes = {r.componentSize: r.numberOfComponents for r in Q["wcc_size_stats"](spark, SF).collect()}
    assert sizes == {" 3": 1, " 4-10": 2, "11-50": 9}
    assert p.users_risk.where("fraudRisk = 1").count() == 39
    assert p.risk_touched_ids().count() == 105
    excl = p.fraud_shared_id_edges().where(F.col("inverseDegreeWeight") == float("inf"))
    assert excl.select("start_guid").distinct().count() == 0
    assert Q["p2p_flagged_share"](spark, SF).first().p == 0.663
    assert p.similarity.count() == 1494
    assert Q["similar_to_communities"](spark, SF).select("userId").distinct().count() == 57
    pr = Q["pagerank_p2p_sent"](spark, SF).agg(F.min("pagerank").alias("lo"), F.max("pagerank").alias("hi")).first()
    assert (pr.lo, pr.hi) == (0.15, 1.956379)
    cards = {r.flaggedUserRatio: r["count"] for r in Q["ratio_buckets_card_flagged"](spark, SF).collect()}
    assert cards == {"0": 190, "Between 0-1": 10}


def test_louvain_on_the_test_graph_is_a_partition_and_improves_modularity(spark):
    from riskgraph.operators.louvain import modularity
    p = pipeline_for(spark, SF)
    nodes, edges = p.louvain_graph()
    lab = p.louvain_labels
    assert lab.count() == nodes.count() == lab.select("node").distinct().count()   # a partition of all nodes
    q = modularity(edges, lab)
    singles = modularity(edges, nodes.select("node", F.col("node").alias("community")))
    assert q > singles + 0.3 and q > 0.7
