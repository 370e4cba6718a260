"""Node similarity in blocks of nodes: against all pairs, and what leaves a block."""

import random

import pytest
from pyspark.sql import functions as F

from riskgraph.operators.similarity import _totals, paired, scored_pairs
from riskgraph.session import cut_lineage

from tests.test_similarity_lists import brute, graph


def test_no_more_than_the_best_pairs_leave_a_block(spark):
    n, k = 300, 2
    rows = [(i, f"g{i // 60}", 0.5) for i in range(n)] + [(i, f"own{i}", 0.1 + 0.001 * i) for i in range(n)]
    df = cut_lineage(spark.createDataFrame(rows, "node long, item string, w double"))
    pairs = scored_pairs(df, 1e-4, k)
    assert pairs.count() <= k * n                               # 8,850 pairs reach the cutoff


@pytest.mark.parametrize("cost,kind", [(40, "long"), (400, "string"), (1_000_000, "long")])
def test_blocks_of_any_cost_give_the_same(spark, cost, kind):
    rows, small, k, cutoff = graph(random.Random(5), 60), 20, 3, 0.01
    df = cut_lineage(spark.createDataFrame(rows, "node long, item string, w double").withColumn("node", F.col("node").cast(kind)))
    sizes = cut_lineage(df.groupBy("item").agg(F.count(F.lit(1)).alias("size")))
    got = {tuple(sorted((int(r["a"]), int(r["b"])))): r["similarity"] for r in
           paired(df, sizes, cut_lineage(_totals(df, sizes, small)), cutoff, k, small, cost).collect()}
    by = {}
    for n, i, _ in rows:
        by.setdefault(i, set()).add(n)
    near = {(a, b) for s in by.values() if len(s) <= small for a in s for b in s}
    for a, b, s in brute(rows, cutoff, 60):
        if (a, b) in near and (min(a, b), max(a, b)) in got:
            assert abs(got[min(a, b), max(a, b)] - s) < 1e-8
    # all nodes that hold the hub, which is large, keep all their partners that do too
    hub = by["hub"]
    want = {(a, b) for a, b, _ in brute(rows, cutoff, 60) if a < b and (a, b) in near and a in hub and b in hub}
    assert want <= set(got)
