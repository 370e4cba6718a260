"""A round of Louvain looks at the links of those nodes alone that may move in it."""

from riskgraph.operators import louvain as lv
from riskgraph.operators.skew import split_hot


def test_a_round_weighs_the_movers_alone_and_two_rounds_all(spark):
    edges = spark.createDataFrame([(i, (i * 7 + 1) % 40, 1.0) for i in range(40)], "src long, dst long, w double")
    entries = lv.symmetric_entries(edges).where("src != dst")
    comm = spark.range(40).selectExpr("id as node", "id div 4 as c")
    for hot in ((10_000, 100_000), (2, 1)):
        links = split_hot(entries, ["dst"], *hot)
        nodes = [{r["node"] for r in lv.weights_to_communities(links, comm, 0, it).collect()} for it in (0, 1)]
        assert nodes[0] and nodes[1] and not nodes[0] & nodes[1]
        assert nodes[0] | nodes[1] == {r["src"] for r in entries.collect()}
