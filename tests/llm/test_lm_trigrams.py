"""op5 scores with contexts of two words, then one, then none; the query itself is held
against its SQL in test_llm_queries."""

import math
from collections import Counter

import numpy as np
import pytest

from riskgraph.llm import lm_backoff

def brute(texts, order, alpha=0.4):
    """(words, words that back off, log_prob) of each text by the definition."""
    docs = [t.split() for t in texts]
    grams = [Counter(tuple(d[i:i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1)) for d in docs]
    total, words = sum(grams, Counter()), sum(map(len, docs))
    for d, own in zip(docs, grams, strict=True):
        rest, backed, lp = Counter({g: total[g] - c for g, c in own.items()}), 0, 0.0
        for i, w in enumerate(d):
            longest = min(i + 1, order)
            n = next((n for n in range(longest, 1, -1) if rest[tuple(d[i - n + 1:i + 1])]), 1)
            score = max(rest[w,], 1) / max(words - len(d), 1) if n == 1 else \
                rest[tuple(d[i - n + 1:i + 1])] / rest[tuple(d[i - n + 1:i])]
            backed += n < longest
            lp += math.log(score) + (longest - n) * math.log(alpha)
        yield len(d), backed, lp


@pytest.mark.parametrize("order", [2, 3, 4])
def test_every_order_equals_brute_force(spark, order):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 12, int(n))) for n in rng.integers(0, 120, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in lm_backoff.lm_scores(docs, order=order, written=False).collect()}
    for i, (n, backed, lp) in enumerate(brute(texts, order)):
        assert (got[i]["n_words"], got[i]["n_backoff"]) == (n, backed)
        assert got[i]["log_prob"] == pytest.approx(lp, abs=1e-6)
