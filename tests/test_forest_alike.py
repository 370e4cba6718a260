"""Rows of the same bins are scored once by the forest, bit for bit as alone."""

import numpy as np
import pyarrow as pa

from riskgraph.operators import forest
from riskgraph.operators.forest import Forest


def made(rng, trees=37, depth=4) -> Forest:
    edges = [np.arange(5.0), np.zeros(0), np.arange(9.0), np.array([0.5])]
    feature = rng.choice([-1, 0, 2, 3], (trees, 2 << depth)).astype(np.int16)
    feature[:, 1 << depth:] = -1
    cut = np.array([[rng.integers(0, max(len(edges[f]), 1)) for f in row] for row in np.maximum(feature, 0)], np.int16)
    return Forest(list("abcd"), edges, feature, cut, rng.random((trees, 2 << depth)))


def test_alike_rows_are_scored_once_and_as_alone(monkeypatch):
    rng = np.random.default_rng(3)
    model = made(rng)
    x = rng.integers(-1, 4, (3000, 4)).astype(float)
    x[7] = np.nan                                           # nulls are below all values
    scored = []
    plain = forest._first_bit
    monkeypatch.setattr(forest, "_first_bit", lambda reach: scored.append(len(reach)) or plain(reach))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in part.T], list("abcd")) for part in np.split(x, [1, 2, 1500])]
    got = np.concatenate([b.column("probability").to_numpy() for b in forest._scored(model)(iter(batches))])
    bins = forest._bins(np.where(np.isnan(x), -np.inf, x), model.edges)
    kinds = len(np.unique(bins, axis=0))
    assert kinds < 300 and sum(scored) <= kinds + 10
    p = np.zeros(len(x))
    for f, c, share in zip(model.feature, model.cut, model.p, strict=True):
        p += share[forest._walk(bins, f, c, 4)]
    assert (got == p / len(model.feature)).all()


def test_few_scores_are_at_hand(monkeypatch):
    monkeypatch.setattr(forest, "KNOWN", 5)
    asked = []
    edges = [np.arange(7.0), np.arange(2.0)]
    run = forest._alike_once(lambda bins: asked.append(len(bins)) or bins @ np.array([1.0, 100.0]), edges)
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 2, 0, 9):
        bins = np.column_stack((rng.integers(0, 8, n), rng.integers(0, 3, n))).astype(np.uint8)
        assert (run(bins) == bins @ np.array([1.0, 100.0])).all()
    assert sum(asked) <= 1 + 3 + 24 + 2 + 9
