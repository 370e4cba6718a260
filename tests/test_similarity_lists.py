"""Node similarity by lists read best first, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from riskgraph.operators import similarity
from riskgraph.operators.similarity import node_similarity, scored_pairs
from riskgraph.session import cut_lineage


def brute(rows, cutoff, k):
    sets = {}
    for n, i, w in rows:
        sets.setdefault(n, {})[i] = w
    total = {n: sum(s.values()) for n, s in sets.items()}
    out = []
    for a, sa in sets.items():
        found = []
        for b, sb in sets.items():
            common = sum(min(sa[i], sb[i]) for i in sa if i in sb)
            if a != b and common:
                score = common / (total[a] + total[b] - common)
                if score >= cutoff:
                    found.append((-round(score, 9), b))
        out += [(a, b, -s) for s, b in sorted(found)[:k]]
    return sorted(out)


def graph(rng, n):
    """Items of very different numbers of holders, weights 1 / (holders - 1)."""
    items = {n_: set() for n_ in range(n)}
    for node in items:
        if rng.random() < 0.9:
            items[node].add("hub")
        if rng.random() < 0.5:
            items[node].add(f"mid{node % 3}")
        for _ in range(rng.choice([0, 0, 1, 2])):
            items[node].add(f"i{rng.randrange(n // 2)}")
    holders = {}
    for s in items.values():
        for i in s:
            holders[i] = holders.get(i, 0) + 1
    return [(node, i, 1.0 / max(holders[i] - 1, 1)) for node, s in items.items() for i in s]


@pytest.mark.parametrize("seed,cutoff,k,small,block", [(1, 0.01, 3, 3, 2), (2, 0.2, 2, 5, 3), (3, 0.001, 10, 2, 4)])
def test_equals_all_pairs(spark, monkeypatch, seed, cutoff, k, small, block):
    monkeypatch.setattr(similarity.scored_pairs, "__defaults__", (small, block))
    rows = graph(random.Random(seed), 70)
    df = spark.createDataFrame(rows, "node long, item string, w double").repartition(4)
    got = sorted((r.node1, r.node2, round(r.similarity, 9)) for r in node_similarity(df, cutoff, k).collect())
    assert got == brute(rows, cutoff, k)


def test_a_hub_of_light_items_with_different_sets_stays_linear(spark):
    n, k = 1500, 3
    # everyone holds the hub; each also shares three items with two others, of different weight
    rows = [(i, "hub", 1.0 / (n - 1)) for i in range(n)]
    rows += [(i, f"p{j}-{(i + j) // 3}", 0.5 + 0.001 * (i % 7)) for i in range(n) for j in range(3)]
    df = cut_lineage(spark.createDataFrame(rows, "node long, item string, w double"))
    pairs = scored_pairs(df, 1e-4, k, small=8)
    assert pairs.count() < 20 * n                               # all pairs share the hub: 1.1 million
    got = {(r["node"], round(r["kth"], 9), r["kth_other"]) for r in similarity._best(pairs, k).where("node < 20").collect()}
    want = brute(rows, 1e-4, k)
    assert got == {(a, s, b) for x in range(20) for a, b, s in [sorted((t for t in want if t[0] == x), key=lambda t: (-t[2], t[1]))[k - 1]]}


def test_nodes_that_hold_nothing_but_the_hub_read_its_best_holders_alone(spark):
    n, k = 900, 4
    rows = [(i, "hub", 0.001) for i in range(n)] + [(i, f"own{i}", 0.0001 * (i + 1)) for i in range(n)]
    df = cut_lineage(spark.createDataFrame(rows, "node long, item string, w double"))
    pairs = scored_pairs(df, 1e-6, k, small=8, block=16)
    assert pairs.count() < 80 * n                               # of 404,550
    got = {(r["node"], r["kth_other"]) for r in similarity._best(pairs, k).where(F.col("node") % 100 == 0).collect()}
    want = brute(rows, 1e-6, k)
    assert got == {(x, sorted((t for t in want if t[0] == x), key=lambda t: (-t[2], t[1]))[k - 1][1]) for x in range(0, n, 100)}
