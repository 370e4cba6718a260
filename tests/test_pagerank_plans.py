"""The driver's part of a PageRank round."""

from pyspark.sql import functions as F

from riskgraph.operators.pagerank import _push, pagerank
from riskgraph.operators.skew import split_hot


def test_a_round_takes_few_calls_of_the_driver(spark, monkeypatch):
    runs = range(6)
    links = spark.range(20).select(F.col("id").alias("src"), ((F.col("id") + 1) % 20).alias("dst"),
                                   *[F.lit(1.0).alias(f"s{i}") for i in runs], F.lit(False).alias("own"))
    state = spark.range(20).select(F.col("id").alias("src"), *[F.lit(0.15).alias(f"r{i}") for i in runs],
                                   *[F.lit(0.0).alias(f"acc{i}") for i in runs])
    split = split_hot(links, ["src"], buckets=2)
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: (calls.append(1), send(*a, **k))[1])
    out = _push(split, state, runs, 0.85, 1e-7)
    n = len(calls)
    monkeypatch.undo()
    assert n < 600
    assert out.columns == ["src", *[f"r{i}" for i in runs], *[f"acc{i}" for i in runs]]
    assert abs(out.agg(F.sum("acc3")).first()[0] - 20 * 0.15 * 0.85) < 1e-12


def test_a_cycle_has_rank_one(spark):
    nodes = spark.range(5).select(F.col("id").alias("guid"))
    edges = spark.range(5).select(F.col("id").alias("src"), ((F.col("id") + 1) % 5).alias("dst"), F.lit(2.0).alias("w"))
    got = [r["pagerank"] for r in pagerank(nodes, edges, weighted=True).collect()]
    assert len(got) == 5 and all(abs(x - 1) < 1e-5 for x in got)
