"""Hand-made graphs (FIXTURES.md §5) and property checks against brute force."""

import itertools
import math
import random

from pyspark.sql import functions as F

from riskgraph.operators import degree as deg
from riskgraph.operators.components import wcc
from riskgraph.operators.graph import NATURAL, REVERSE, UNDIRECTED, orient, project
from riskgraph.operators.louvain import louvain, modularity, symmetric_entries
from riskgraph.operators.pagerank import pagerank, pagerank_many
from riskgraph.operators.resolve import er_p2p_shared_card, er_shared_ids, label_fraud_risk
from riskgraph.operators.similarity import node_similarity


def _nodes(spark, ids, t="long"):
    return spark.createDataFrame([(i,) for i in ids], f"guid {t}")


def _edges(spark, pairs, t="long"):
    return spark.createDataFrame(pairs, f"src {t}, dst {t}")


# ---- projections ----------------------------------------------------------
def test_self_loop_undirected_once_and_parallel_sum_single(spark):
    e = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (1, 2, 3.0)], "start_guid long, end_guid long, a double")
    und = orient(e, UNDIRECTED, "a").collect()
    assert sum(1 for r in und if r.src == 1 and r.dst == 1) == 1
    assert len(und) == 5
    s = {(r.src, r.dst): r.w for r in project({"P": e}, {"P": {"aggregation": "SUM", "weight": "a"}}).collect()}
    assert s[(1, 2)] == 5.0
    single = project({"P": e}, {"P": {"aggregation": "SINGLE"}}).collect()
    assert len(single) == 2
    rev = {(r.src, r.dst) for r in orient(e, REVERSE).collect()}
    assert (2, 1) in rev and (1, 2) not in rev
    nat = orient(e, NATURAL).count()
    assert nat == 3


def test_degree_isolated_and_parallel(spark):
    nodes = _nodes(spark, [1, 2, 3])
    e = spark.createDataFrame([(1, 2, 1.0), (1, 2, 1.0)], "src long, dst long, w double")
    d = {r.guid: r.degree for r in deg.degree(nodes, e).collect()}
    assert d == {1: 2, 2: 0, 3: 0}
    wd = {r.guid: r.wd for r in deg.degree(nodes, e, "wd", weight="w").collect()}
    assert wd[1] == 2.0 and wd[3] == 0.0


# ---- entity resolution -----------------------------------------------------
def test_rule1_excludes_self_transfer(spark):
    p2p = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "start_guid long, end_guid long")
    cc = spark.createDataFrame([(1, "c"), (1, "c"), (2, "c"), (3, "c")], "start_guid long, end_guid string")
    out = [(r.start_guid, r.end_guid) for r in er_p2p_shared_card(p2p, cc).collect()]
    assert out == [(1, 2)]


def test_rule2_hub_boundary(spark):
    # card 'h10' has 10 users (allowed), 'h11' has 11 (not a candidate source)
    rows = []
    for u in range(10):
        rows.append((u, "h10", "HAS_CC", "Card"))
    for u in range(100, 111):
        rows.append((u, "h11", "HAS_CC", "Card"))
    # users 0,1 share two more ids; 100,101 share two more ids
    for u in (0, 1, 100, 101):
        rows.append((u, f"ip{u // 100}", "HAS_IP", "IP"))
        rows.append((u, f"d{u // 100}", "USED", "Device"))
    ide = spark.createDataFrame(rows, "start_guid long, end_guid string, rel string, end_label string")
    degs = ide.groupBy(F.col("end_guid").alias("guid")).agg(F.count(F.lit(1)).alias("degree"))
    out = {(r.start_guid, r.end_guid) for r in er_shared_ids(ide, degs).collect()}
    # 0,1 share h10 (deg 10), ip0, d0 -> 3 ids; 100,101 share the device d1 (deg 2) and ip1, h11 -> 3 ids
    assert (0, 1) in out and (100, 101) in out
    assert all(a < b for a, b in out)
    # pairs sharing only h10 have one shared id: excluded
    assert (2, 3) not in out


# ---- components --------------------------------------------------------------
def _union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for i in range(n):
        comp.setdefault(find(i), []).append(i)
    return {i: min(members) for members in comp.values() for i in members}


def test_wcc_matches_union_find_on_random_graphs(spark):
    rnd = random.Random(7)
    for n, m in ((30, 20), (200, 150), (120, 400)):
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
        # a long path too: worst case for label propagation
        pairs += [(i, i + 1) for i in range(0, min(n - 1, 60))]
        got = {r.guid: r.wccId for r in wcc(_nodes(spark, range(n)), _edges(spark, pairs)).collect()}
        assert got == _union_find(n, pairs)


def test_fraud_risk_labels(spark):
    users = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "guid long, fraudMoneyTransfer int")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "guid long, wccId long")
    out = {r.guid: r.fraudRisk for r in label_fraud_risk(users, labels).collect()}
    assert out == {1: 1, 2: 1, 3: 0}


# ---- PageRank -------------------------------------------------------------------
def test_pagerank_cycle_isolated_and_fixed_point(spark):
    nodes = _nodes(spark, [1, 2, 3, 4])
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0)], "src long, dst long, w double")
    pr = {r.guid: r.pagerank for r in pagerank(nodes, e, max_iter=1000, tol=1e-9).collect()}
    assert abs(pr[1] - 1.0) < 1e-6 and abs(pr[3] - 1.0) < 1e-6
    assert abs(pr[4] - 0.15) < 1e-12


def test_pagerank_weighted_shares_and_many(spark):
    nodes = _nodes(spark, [1, 2, 3])
    e = spark.createDataFrame([(1, 2, 3.0), (1, 3, 1.0), (2, 3, -5.0)], "src long, dst long, w double")
    r = {(x.variant, x.guid): x.pagerank for x in
         pagerank_many(nodes, {"w": (e, True), "u": (e, False)}, max_iter=3).collect()}
    assert abs(r[("w", 2)] - (0.15 + 0.85 * 0.15 * 0.75)) < 1e-12
    assert abs(r[("u", 2)] - (0.15 + 0.85 * 0.15 * 0.5)) < 1e-12
    # non-positive weights are ignored in the weighted run
    assert abs(r[("w", 3)] - (0.15 + 0.85 * 0.15 * 0.25)) < 1e-12


# ---- similarity ----------------------------------------------------------------------
def _brute_similarity(members, cutoff, k):
    by = {}
    for node, item, w in members:
        by.setdefault(node, {})[item] = max(w, by.get(node, {}).get(item, 0))
    out = []
    for a in by:
        cands = []
        for b in by:
            if a == b:
                continue
            shared = set(by[a]) & set(by[b])
            if not shared:
                continue
            inter = sum(min(by[a][i], by[b][i]) for i in shared)
            union = sum(by[a].values()) + sum(by[b].values()) - inter
            s = inter / union if union else 0.0
            if math.isnan(s) or s < cutoff:
                continue
            cands.append((-round(s, 9), b, s))
        cands.sort()
        out += [(a, b, round(s, 9)) for _, b, s in cands[:k]]
    return sorted(out)


def test_similarity_prefix_filter_equals_brute_force(spark):
    rnd = random.Random(3)
    members = []
    n_users, n_items = 80, 40
    for u in range(n_users):
        for _ in range(rnd.randint(1, 5)):
            members.append((u, f"i{rnd.randrange(n_items)}", 0.0))
    # hub item used by half of the users; exclusive item with infinite weight
    for u in range(0, n_users, 2):
        members.append((u, "hub", 0.0))
    members.append((5, "only5", 0.0))
    degree = {}
    for u, i, _ in members:
        degree[i] = degree.get(i, 0) + 1
    members = [(u, i, float("inf") if degree[i] == 1 else 1.0 / (degree[i] - 1)) for u, i, _ in members]
    df = spark.createDataFrame(members, "node long, item string, w double")
    for cutoff, k in ((0.01, 10), (0.3, 3)):
        got = sorted((r.node1, r.node2, round(r.similarity, 9)) for r in node_similarity(df, cutoff, k).collect())
        assert got == _brute_similarity(members, cutoff, k)
    assert all(r.node1 != 5 for r in node_similarity(df, 0.01, 10).collect())   # exclusive id: score 0


def test_similarity_ties_go_to_smaller_id(spark):
    members = [(0, "x", 1.0)] + [(u, "x", 1.0) for u in range(1, 13)]
    df = spark.createDataFrame(members, "node long, item string, w double")
    got = [r.node2 for r in node_similarity(df, 0.01, 10).where("node1 = 0").orderBy("node2").collect()]
    assert got == list(range(1, 11))


# ---- Louvain ---------------------------------------------------------------------------
def test_louvain_two_cliques(spark):
    pairs = [(a, b) for a, b in itertools.combinations(range(5), 2)]
    pairs += [(a, b) for a, b in itertools.combinations(range(5, 10), 2)]
    pairs += [(4, 5)]
    und = spark.createDataFrame([(str(a), str(b), 1.0) for a, b in pairs], "src string, dst string, w double")
    entries = symmetric_entries(und)
    nodes = spark.createDataFrame([(str(i),) for i in range(10)] + [("iso",)], "node string")
    res = {r.node: r.community for r in louvain(nodes, entries).collect()}
    assert len({res[str(i)] for i in range(5)}) == 1
    assert len({res[str(i)] for i in range(5, 10)}) == 1
    assert res["0"] != res["9"]
    assert res["iso"] == "iso"
    q = modularity(entries, spark.createDataFrame(list(res.items()), "node string, community string"))
    singles = modularity(entries, spark.createDataFrame([(n, n) for n in res], "node string, community string"))
    assert q > singles and q > 0.4


def test_similarity_copy_groups_equal_brute_force(spark):
    rnd = random.Random(11)
    members = []
    # a big group of copies (identical sets), a few smaller groups, and noise
    for u in range(0, 60):
        members += [(u, "a", 0.0), (u, "b", 0.0)]
    for u in range(60, 75):
        members += [(u, "a", 0.0), (u, "c", 0.0)]
    for u in range(75, 120):
        for _ in range(rnd.randint(1, 4)):
            members.append((u, f"i{rnd.randrange(12)}", 0.0))
        if u % 3 == 0:
            members.append((u, "a", 0.0))
    degree = {}
    for u, i, _ in members:
        degree[i] = degree.get(i, 0) + 1
    members = [(u, i, float("inf") if degree[i] == 1 else 1.0 / (degree[i] - 1)) for u, i, _ in members]
    df = spark.createDataFrame(members, "node long, item string, w double")
    for cutoff, k in ((0.01, 10), (0.2, 4)):
        got = sorted((r.node1, r.node2, round(r.similarity, 9)) for r in node_similarity(df, cutoff, k).collect())
        assert got == _brute_similarity(members, cutoff, k)


def test_hot_key_split_gives_same_results(spark):
    # a hub sending to / linked with many nodes: force the hot path with tiny thresholds
    nodes = _nodes(spark, range(40))
    pairs = [(0, i, 1.0) for i in range(1, 40)] + [(i, (i + 1) % 40, 2.0) for i in range(1, 40)]
    e = spark.createDataFrame(pairs, "src long, dst long, w double")
    plain = {(r.variant, r.guid): r.pagerank for r in pagerank_many(nodes, {"u": (e, False), "w": (e, True)}, max_iter=6).collect()}
    split = {(r.variant, r.guid): r.pagerank for r in pagerank_many(nodes, {"u": (e, False), "w": (e, True)}, max_iter=6,
                                                                   max_hot_keys=2, min_hot_degree=5).collect()}
    assert plain.keys() == split.keys()
    assert all(abs(plain[k] - split[k]) < 1e-12 for k in plain)
    und = spark.createDataFrame([(str(a), str(b), w) for a, b, w in pairs], "src string, dst string, w double")
    entries = symmetric_entries(und)
    lnodes = spark.createDataFrame([(str(i),) for i in range(40)], "node string")
    a = {r.node: r.community for r in louvain(lnodes, entries).collect()}
    b = {r.node: r.community for r in louvain(lnodes, entries, max_hot_keys=2, min_hot_degree=5).collect()}
    assert a == b


def test_projection_restricted_to_label_subsets(spark):
    # HAS_CC edges of three users; only users 1 and 3 are "flagged"
    e = spark.createDataFrame([(1, "c1"), (2, "c1"), (3, "c2"), (3, "c2")], "start_guid long, end_guid string")
    flagged = _nodes(spark, [1, 3])
    cards = spark.createDataFrame([("c1",), ("c2",)], "guid string")
    p = project({"HAS_CC": e}, {"HAS_CC": {"orientation": REVERSE}}, src_nodes=flagged, dst_nodes=cards)
    got = sorted((r.src, r.dst) for r in p.collect())
    assert got == [("c1", 1), ("c2", 3), ("c2", 3)]        # user 2's edge vanished, parallel kept
    d = {r.guid: r.flaggedDegree for r in deg.degree(cards, p, "flaggedDegree").collect()}
    assert d == {"c1": 1, "c2": 2}
