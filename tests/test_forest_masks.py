"""Scoring by leaf masks equals walking the trees."""

import numpy as np
import pyarrow as pa
import pytest

from riskgraph.operators import forest


def grown(rng, trees, depth, edges):
    shape = (trees, 2 << depth)
    feature, cut = np.full(shape, -1, np.int16), np.zeros(shape, np.int16)
    for t in range(trees):
        for n in range(1, 1 << depth):
            if (n == 1 or feature[t, n >> 1] >= 0) and rng.random() < 0.85:
                feature[t, n] = f = rng.integers(0, len(edges) - 1)
                cut[t, n] = rng.integers(0, len(edges[f]))
    return forest.Forest([f"f{i}" for i in range(len(edges))], edges, feature, cut, rng.random(shape))


@pytest.mark.parametrize("depth", [0, 1, 4, 5, 6, 7])
def test_masks_and_walks_give_the_same_scores(depth):
    rng = np.random.default_rng(depth)
    edges = [np.arange(31.0), np.arange(4.0), np.zeros(1), np.zeros(0)]
    model = grown(rng, 40, depth, edges)
    x = [rng.integers(-2, 33, 1500).astype(float) for _ in edges]
    x[0][::7] = np.nan
    batch = pa.RecordBatch.from_arrays([pa.array(c, from_pandas=True) for c in x], model.features)
    bins = forest._bins(forest._matrix(batch, model.features), edges)
    want = np.zeros(len(bins))
    for f, c, p in zip(model.feature, model.cut, model.p, strict=True):
        want += p[forest._walk(bins, f, c, depth)]
    got = np.concatenate([b.column("probability").to_numpy() for b in forest._scored(model)(iter([batch]))])
    assert (got == want / 40).all()
    if depth <= 6:
        masks, values = forest._leaf_masks(model)
        assert values.shape == (40, 1 << depth) and [len(m) for m in masks] == [32, 5, 2, 1]
