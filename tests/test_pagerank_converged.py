"""The pipeline's PageRank runs reach their fixed point (the reference asks for
at most 1000 rounds), not a round count."""

import numpy as np
import pytest

from riskgraph.plans.pipeline import FraudPipeline
from tests.conftest import SF_SMALL


def test_all_variants_reach_the_fixed_point(spark):
    p = FraudPipeline.for_testdata(spark, SF_SMALL, materialize=True)
    guids = sorted(r["guid"] for r in p.users.select("guid").collect())
    place = {g: i for i, g in enumerate(guids)}
    got = {(r["variant"], r["guid"]): r["pagerank"] for r in p.pageranks.collect()}
    for name, (edges, weighted) in p.pagerank_variants().items():
        m = np.zeros((len(guids), len(guids)))
        for r in edges.collect():
            if not weighted or r["w"] > 0:
                m[place[r["dst"]], place[r["src"]]] += r["w"] if weighted else 1.0
        out = m.sum(axis=0)
        m /= np.where(out > 0, out, 1.0)
        want = np.linalg.solve(np.eye(len(guids)) - 0.85 * m, np.full(len(guids), 0.15))
        assert [got[name, g] for g in guids] == pytest.approx(want.tolist(), abs=1e-6), name
