"""Rows that repeat a vec_id and its vector: results as by brute force, and no
shard that holds them all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph.llm import ann_vptree, shards, topk_balltree
from tests.llm.test_llm_operators import brute_top, embeddings


@pytest.fixture(scope="module")
def rows():
    v = np.random.default_rng(8).normal(size=(400, 8)).astype(np.float32) / 4
    v = [(i, [float(x) for x in v[i]], 1, 7) for i in range(400)]
    return v + [v[0]] * 1000 + [v[7]] * 1000 + [v[9]] * 3


def test_shards_are_bounded(spark, rows):
    vectors, _, n, _ = shards.dealt(embeddings(spark, rows), F.lit(True), 20, 100, 16, 20)
    sizes = [r["count"] for r in vectors.groupBy("shard").count().collect()]
    assert n > 1 and max(sizes) <= 200
    assert vectors.where("vec_id = 7").count() == 20 and vectors.where("vec_id = 9").count() == 4


@pytest.mark.parametrize("op, turn", [
    (lambda d: topk_balltree.topk(d, k=10, every=20, shard_rows=100, block_rows=16, leaf=16), lambda x: np.floor(1024 * x)),
    (lambda d: ann_vptree.nearest(d, k=10, every=20, factor=1.0, shard_rows=100, block_rows=16, leaf=16), lambda x: x)])
def test_every_copy_counts(spark, rows, op, turn):
    got = {}
    for r in op(embeddings(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_top(rows, 10, 20, turn)
    assert set(got) == set(want)
    for q, best in want.items():
        assert [n for n, _, _ in sorted(got[q])] == list(range(1, 11))
        assert [i for _, i, _ in sorted(got[q])] == [i for _, i in best]
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([-s for s, _ in best], abs=1e-9)
