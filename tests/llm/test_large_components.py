"""op10 with components far beyond 2^53, against whole numbers of any length."""

import math
import random

import numpy as np
import pytest

from riskgraph.llm import topk_balltree
from riskgraph.llm.topk_balltree import LONG, BallTree, whole_dot


def floor_scaled(x):
    y = max(min(float(x) * 1024, 2.0 ** 200), -(2.0 ** 200))
    return math.floor(y)


def brute(rows, k, every):
    out = {}
    for q, v in rows:
        if q % every:
            continue
        found = []
        for i, w in rows:
            if i != q:
                s = sum(floor_scaled(a) * floor_scaled(b) for a, b in zip(v, w))
                found.append((-min(max(s, -LONG - 1), LONG), i))
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_components_of_2_30_to_2_45(spark, shard_rows):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        size = rng.choice([0, 0, 20, 25, 30, 35])
        rows.append((i, [rng.uniform(-1, 1) * 2.0 ** size for _ in range(5)]))
    rows += [(120, [2.0 ** 30, 1.0, 0.0, 0.0, 0.0]), (121, [2.0 ** 31, 2.0 ** -10, 0.0, 0.0, 0.0]),
             (122, [1e300, 0.0, 0.0, 0.0, 1.0]), (123, [0.0, 0.0, 0.0, -1.7e308, 1.0]), (124, [0.0] * 5)]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (204, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in topk_balltree.topk(df, k=7, every=10, shard_rows=shard_rows, leaf=8).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute(rows, 7, 10)


def test_products_do_not_wrap_and_neighbours_keep_their_order():
    a = np.array([[2.0 ** 40, 3.0], [2.0 ** 31, 1.0], [2.0 ** 31, 1.0]])
    b = np.array([[2.0 ** 40, 1.0], [2.0 ** 31, 3.0], [2.0 ** 31, 2.0]])
    high, low = whole_dot(a, b)
    assert [int(h) + int(x) for h, x in zip(high, low)] == [LONG, 2 ** 62 + 3, 2 ** 62 + 2]


def test_a_huge_row_does_not_make_others_inexact():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(500, 8)) * 1024)
    x[7] = 2.0 ** 60
    ids = np.arange(500)
    best = topk_balltree.TopK(np.arange(0, 500, 50), 5)
    BallTree(x, 16).search(x[::50], ids, best)
    for j, q in enumerate(range(0, 500, 50)):
        s = [(-min(max(sum(int(u) * int(w) for u, w in zip(x[q], x[i])), -LONG - 1), LONG), i) for i in ids if i != q]
        assert best.id[j].tolist() == [i for _, i in sorted(s)[:5]]
