"""Nodes of different labels with equal guids stay apart; joins back to a group
that holds a third of the rows are spread over tasks."""

import pytest
from pyspark.sql import functions as F

from riskgraph.operators.dictionary import dense_ids
from riskgraph.operators.graph import Graph
from riskgraph.operators.joinback import heavy_keys, join_back, salted_join
from riskgraph.operators.resolve import er_p2p_shared_card, label_fraud_risk
from riskgraph.plans import reports
from riskgraph.plans.pipeline import FraudPipeline
from riskgraph.session import cut_lineage


@pytest.fixture()
def no_merging(spark):
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def rows_with_hot_key(spark, n=30_000):
    # key 0 holds a third of the rows; 2,000 of its rows are equal in every column
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 977 + 1)
    return cut_lineage(spark.range(n).repartition(8).select(
        k.alias("k"), F.when(F.col("id") < 6_000, F.lit(-1)).otherwise(F.col("id")).alias("v")))


def largest_task(df):
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return max(r["n"] for r in per)


def test_join_back_spreads_a_hot_key(spark, no_merging):
    rows = rows_with_hot_key(spark)
    plain = rows.join(cut_lineage(rows.groupBy("k").agg(F.sum("v").alias("s"))), "k")
    spread = join_back(rows, ["k"], min_rows=1_000, s=F.sum("v"))
    assert largest_task(plain) > 10_000
    assert largest_task(spread) < 4_500
    assert sorted(map(tuple, spread.select("k", "v", "s").collect())) == \
        sorted(map(tuple, plain.select("k", "v", "s").collect()))


def test_only_keys_above_the_share_are_heavy_and_at_most_that_many(spark):
    counts = cut_lineage(rows_with_hot_key(spark).groupBy("k").agg(F.count(F.lit(1)).alias("__n")))
    assert [r["k"] for r in heavy_keys(counts, ["k"], max_heavy=50, min_rows=1).collect()] == [0]
    assert heavy_keys(counts, ["k"]) is None
    assert heavy_keys(counts, ["k"], max_heavy=10_000, min_rows=1).count() <= 10_000


def test_salted_join_keeps_semi_left_and_null_semantics(spark):
    rows = cut_lineage(spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, x string"))
    side = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "k int, y int")
    heavy = spark.createDataFrame([(1,)], "k int")
    for how in ("inner", "left", "left_semi"):
        want, got = rows.join(side, ["k"], how), salted_join(rows, side, ["k"], heavy, how, salts=5)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), how


def test_rules_and_labels_with_hot_keys_equal_the_plain_ones(spark, no_merging):
    p2p = spark.range(400).select(F.lit(0).alias("start_guid"), (F.col("id") % 40 + 1).alias("end_guid")).unionByName(
        spark.range(200).select((F.col("id") % 17).alias("start_guid"), (F.col("id") % 41).alias("end_guid")))
    cc = spark.range(300).select((F.col("id") % 41).alias("start_guid"),
                                 F.concat(F.lit("C"), (F.col("id") % 7).cast("string")).alias("end_guid"))
    want = set(map(tuple, er_p2p_shared_card(p2p, cc).collect()))
    got = list(map(tuple, er_p2p_shared_card(p2p, cc, max_heavy=20, min_heavy_rows=5).collect()))
    assert want and set(got) == want and len(got) == len(want)
    users = spark.range(3000).select(F.col("id").alias("guid"), (F.col("id") == 8).cast("int").alias("fraudMoneyTransfer"))
    labels = spark.range(3000).select(F.col("id").alias("guid"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("wccId"))
    out = label_fraud_risk(users, labels, min_rows=100)
    assert {r["guid"] for r in out.where("fraudRisk = 1").collect()} == set(range(1000)) and out.count() == 3000
    assert largest_task(out) < 800


def test_components_with_a_hub_of_a_third_of_the_edges(spark, no_merging):
    from riskgraph.operators import components
    hub = spark.range(1, 9_001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    rest = spark.range(9_001, 27_000).select(F.col("id").alias("src"), (F.col("id") - F.col("id") % 7).alias("dst"))
    edges = cut_lineage(hub.unionByName(rest))
    want = {r["node"]: r["comp"] for r in components.component_map(edges).collect()}
    got = {r["node"]: r["comp"] for r in components.component_map(edges, max_heavy=50, min_heavy_rows=500).collect()}
    assert got == want and sum(c == 0 for c in got.values()) > 9_000
    both = components._both(cut_lineage(components._canonical(edges.toDF("u", "v"))))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("__n"))
    assert largest_task(components._joined_min(both, least, None)) > 9_000
    assert largest_task(components._joined_min(both, least, (50, 500))) < 5_500


def test_dense_ids_are_the_ranks_under_any_partitioning(spark):
    keys = [(a, f"{b:03d}") for a in ("Card", "Device") for b in range(0, 300, 3)]
    for parts in (1, 3, 9):
        df = spark.createDataFrame(keys * 2, "label string, guid string").repartition(parts)
        got = {(r["label"], r["guid"]): r["id"] for r in dense_ids(df, ["label", "guid"]).collect()}
        assert got == {k: i for i, k in enumerate(sorted(keys))}
    assert dense_ids(spark.createDataFrame([], "label string, guid string"), ["label", "guid"]).collect() == []


@pytest.fixture(scope="module")
def colliding(spark):
    """Card X, device X and IP X are three nodes. Users 1 and 2 share card X,
    device X and IP X; user 3 has device X only once more; 4 has IP X."""
    def nodes(*guids):
        return spark.createDataFrame([(g,) for g in guids], "guid string")

    def edges(*pairs):
        return spark.createDataFrame(list(pairs), "start_guid string, end_guid string")
    users = spark.createDataFrame([("1", 1), ("2", 0), ("3", 0), ("4", 0), ("X", 0)], "guid string, fraudMoneyTransfer int")
    p2p = spark.createDataFrame([("1", "2", 5.0)], "start_guid string, end_guid string, totalAmount double")
    g = Graph({"User": users, "Card": nodes("X", "Y"), "Device": nodes("X"), "IP": nodes("X")},
              {"HAS_CC": edges(("1", "X"), ("2", "X"), ("3", "Y")), "USED": edges(("1", "X"), ("2", "X"), ("3", "X")),
               "HAS_IP": edges(("1", "X"), ("2", "X"), ("4", "X")), "P2P": p2p, "REFERRED": edges()})
    return FraudPipeline(spark, g)


def test_shared_ids_count_a_card_a_device_and_an_ip_of_one_guid_as_three(colliding):
    assert [tuple(r) for r in colliding.shared_ids().collect()] == [("1", "2")]


def test_degrees_and_weights_are_those_of_the_label(colliding):
    w = {(r["start_guid"], r["end_label"], r["end_guid"]): r["inverseDegreeWeight"]
         for r in colliding.fraud_shared_id_edges().collect()}
    assert w[("1", "Card", "X")] == 1.0 and w[("3", "Device", "X")] == 0.5 and w[("4", "IP", "X")] == 0.5
    assert ("3", "Card", "Y") not in w                              # no risk user has card Y
    assert {(r["label"], r["guid"]) for r in colliding.risk_touched_ids().collect()} == \
        {("Card", "X"), ("Device", "X"), ("IP", "X")}
    top = {r["uid"]: r["numberFraudRiskIds"] for r in reports.weighted_degree_top(colliding).collect()}
    assert top == {"3": 1, "4": 1}


def test_louvain_merges_no_user_with_a_card_of_its_guid(colliding):
    nodes, edges = colliding.louvain_graph()
    assert nodes.count() == 5 + 2 + 1                               # users, cards, devices
    label = {r["id"]: (r["label"], r["guid"]) for r in colliding.node_ids.collect()}
    assert ("User", "X") not in {label[r["src"]] for r in edges.select("src").distinct().collect()}
    community = {r["guid"]: r["louvainCommunityId"] for r in colliding.louvain_users().collect()}
    assert len(community) == 5 and community["X"] not in {community[g] for g in "1234"}
