"""First moves from singletons: every link read once, both ends served; IP edges are not joined for it."""

import random

from riskgraph.operators import louvain as lv
from riskgraph.plans.pipeline import FraudPipeline
from tests.conftest import SF_SMALL


def _brute(entries):
    k, two_m = {}, sum(w for *_, w in entries)
    for a, _, w in entries:
        k[a] = k.get(a, 0.0) + w
    m, best = two_m / 2, {}
    for a, b, w in entries:
        if a != b:
            key = (-round(w / m - k[a] * k[b] / (2 * m * m), 15), b)
            best[a] = min(best.get(a, key), key)
    return {a: b for a, (_, b) in best.items()}


def test_first_moves_equal_brute_force_with_loops_hubs_and_parallel_links(spark):
    rng = random.Random(5)
    und = [(rng.randrange(40), rng.randrange(40), 1.0) for _ in range(90)] + [(0, i, 1.0) for i in range(40)]
    directed = [(rng.randrange(40), rng.randrange(40), 1.0) for _ in range(60)] + [(7, 7, 1.0), (8, 9, 1.0), (9, 8, 1.0)]
    d = lambda rows: spark.createDataFrame(rows, "src long, dst long, w double")
    e = lv.symmetric_entries(d(und), d(directed))
    entries = [tuple(r) for r in e.collect()]
    want = {}
    for rows, half in ((und, 1.0), (directed, 0.5)):
        for a, b, w in rows:
            for x in {(a, b), (b, a)}:
                want[x] = want.get(x, 0.0) + (w if a == b else w * half)
    assert {(a, b): w for a, b, w in entries} == want and len(entries) == len(want)
    moves = lv.first_moves(e).collect()
    assert {r["node"]: r["target"] for r in moves} == _brute(entries)


def test_links_get_degrees_once_and_ip_edges_stay_out(spark):
    p = FraudPipeline.for_testdata(spark, SF_SMALL)
    _, edges = p.louvain_graph()
    assert "typed_id_edges" not in p.__dict__
    owned = p.owned_id_edges.groupBy("start_guid", "end_id").count()
    typed = p.typed_id_edges.where("rel != 'HAS_IP'").groupBy("start_guid", "end_id").count()
    assert owned.exceptAll(typed).isEmpty() and typed.exceptAll(owned).isEmpty()
    moves = lv.first_moves(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "(src#" in moves and " < dst#" in moves
