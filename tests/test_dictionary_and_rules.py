"""The dictionary from the edges' ends, rule 2 against brute force."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from riskgraph.operators.dictionary import edge_ends, node_dictionary, with_end_ids
from riskgraph.operators.graph import Graph
from riskgraph.operators.resolve import er_shared_ids


def _edges(spark):
    rng = np.random.default_rng(4)
    rels = {"HAS_CC": "Card", "USED": "Device", "HAS_IP": "IP"}
    rows = [(int(u), f"x{rng.integers(0, 14)}", r, lab) for u in range(30) for r, lab in rels.items() for _ in range(4)]
    return spark.createDataFrame(rows + [(None, "x1", "USED", "Device"), (3, None, "HAS_CC", "Card")],
                                 "start_guid long, end_guid string, rel string, end_label string")


def test_the_dictionary_of_the_ends_is_the_dictionary_of_the_nodes(spark):
    e = _edges(spark)
    users = spark.range(40).select(F.col("id").alias("guid"))
    nodes = {"User": users, **{lab: e.where(F.col("end_label") == lab).select(F.col("end_guid").alias("guid")).distinct()
                               for lab in ("Card", "Device", "IP")}}
    ends = edge_ends(e)
    assert ends.agg(F.sum("__n")).first()[0] == e.count()
    plain = node_dictionary(Graph(nodes, {}, e)).collect()
    short = node_dictionary(Graph(nodes, {}, e, {"nodes_of_edges": ("Card", "Device", "IP")}), ends)
    assert sorted(map(str, plain)) == sorted(map(str, short.collect()))
    typed = with_end_ids(e, short, ends)
    ids = {(r["label"], r["guid"]): r["id"] for r in plain}
    got = typed.collect()
    assert len(got) == e.where("end_guid is not null").count()
    assert all(r["end_id"] == ids[r["end_label"], r["end_guid"]] for r in got)
    # an isolated node of a loaded graph is in it
    more = Graph({**nodes, "Card": nodes["Card"].unionByName(spark.createDataFrame([("alone",)], "guid string"))}, {}, e)
    assert node_dictionary(more).where("guid = 'alone'").count() == 1


def test_rule_2_equals_brute_force(spark):
    e = _edges(spark).withColumn("end_guid", F.concat("end_label", "end_guid"))
    degree = e.groupBy(F.col("end_guid").alias("guid")).agg(F.count(F.lit(1)).alias("degree"))
    rows, low = e.collect(), {r["guid"] for r in degree.where("degree <= 10").collect()}
    own, ids = {}, {}
    for r in rows:
        if r["start_guid"] is not None and r["end_guid"] is not None:
            ids.setdefault(r["start_guid"], set()).add(r["end_guid"])
            if r["rel"] != "HAS_IP" and r["end_guid"] in low:
                own.setdefault(r["start_guid"], set()).add(r["end_guid"])
    want = {(a, b) for a, b in combinations(sorted(ids), 2)
            if own.get(a, set()) & own.get(b, set()) and len(ids[a] & ids[b]) >= 3}
    got = [tuple(r) for r in er_shared_ids(e, degree, 10, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    # all edges meet in one shuffle, then a table of a user's identifiers is read
    plan = er_shared_ids(e, degree, 10, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan
