"""Toxicity by weak supervision.

1. Features of a text: its distinct words (lower case, punctuation trimmed),
   and their beginnings and ends of 4 to 6 letters. On a bounded sample of
   labelled rows (``LABELLED``, those of smallest hash) all features that stand
   out in toxic rows are taken: in ``MIN_ROWS`` toxic rows or more, a
   log-likelihood ratio of at least ``MIN_RATIO``, and ``MIN_PRECISION`` of the
   rows that have it toxic. A word of over ``LONG_WORD`` letters is named by its
   digest, so no feature is longer than that.
2. Voters: ``VOTERS / 2`` lexicons hold the words among them and as many
   pattern voters the beginnings and ends. A voter fires on a text that has one
   of its features, else it abstains.
3. A generative label model is fitted, without labels, to how often each set of
   voters fires together (2^16 sets at most, counted over all texts that are
   not held out): each voter's rates of firing on toxic and clean texts by
   expectation-maximization, and the voters' correlations given the class, by
   which voters that say the same count less. It gives each set a posterior.
4. A linear classifier (logistic regression over the features' presence and
   the numbers of words and patterns hit) learns the posteriors on a bounded
   sample of ``SAMPLE`` texts, half of them with a vote, weighted back to all.

Labels are read only for rows whose crc32(doc_id as text) mod 4 is not 2; the
others are held out. Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null and empty texts score like texts without features; a null
doc_id is not held out and has no label; several labels of a doc_id count as
toxic if one is; rows that repeat a doc_id are scored each by its own text; no
labels or no toxic ones: every text gets the same low score; an empty table
gives an empty result; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage, releasing, strings

LABELLED = 20_000       # rows of labels that are used at most
SAMPLE = 20_000         # texts on which the classifier is fitted at most
VOTERS = 16
MIN_RATIO = 16.0
MIN_PRECISION = 0.95
MIN_ROWS = 3
THRESHOLD = 0.3
LONG_WORD = 64
SLICE = 500                     # texts that are Python strings at a time
MEMO_BYTES = 24 << 20           # of remembered words, about
COUNT_BYTES = 32 << 20          # of counted features, about, before they go out
ENTRY_BYTES = 250               # a dictionary entry with its key and value, about

_TRIM = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*_/\\|#&%$+=~^`"


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def features_of(raw: str) -> list[str]:
    """A word's features: itself, its beginnings and its ends."""
    w = raw.strip(_TRIM)
    if not w:
        return []
    out = ["w" + w if len(w) <= LONG_WORD else "w#" + hashlib.blake2b(w.encode("utf-8", "surrogatepass"),
                                                                      digest_size=16).hexdigest()]
    for n in (4, 5, 6):
        if len(w) >= n:
            out.append("b" + w[:n])
            out.append("e" + w[-n:])
    return out


def _words(text: str) -> set[str]:
    return set(text.lower().split())


class _Memo(dict):
    """Raw word -> ``look(its features)``. Long words are not kept, and all are
    forgotten when they fill ``MEMO_BYTES``."""

    def __init__(self, look):
        super().__init__()
        self.look, self.size = look, 0

    def __missing__(self, raw: str):
        got = self.look(features_of(raw))
        if len(raw) <= LONG_WORD:
            self.size += ENTRY_BYTES + len(raw) + 60 * len(got)
            if self.size > MEMO_BYTES:
                self.clear()
                self.size = 0
            self[raw] = got
        return got


def _wanted(features: list[str]) -> _Memo:
    """Raw word -> numbers of those of its features that are in the list."""
    number = {f: i for i, f in enumerate(features)}
    return _Memo(lambda own: tuple(number[f] for f in own if f in number))


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, SLICE):
        yield b.slice(at, SLICE)


def _numbers(memo: _Memo, text: str) -> set[int]:
    out: set[int] = set()
    for got in map(memo.__getitem__, _words(text)):
        if got:
            out.update(got)
    return out


@releasing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and how many clean rows each feature is; counts go
    out whenever they fill ``COUNT_BYTES``."""
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array([t for t, _ in seen.values()], pa.int64()),
             pa.array([n for _, n in seen.values()], pa.int64())], ["feature", "t", "n"])

    memo, seen, size = _Memo(tuple), {}, 0
    for whole in batches:
        for b in _slices(whole):
            for text, toxic in zip(strings(b.column("text")), b.column("toxic").to_pylist(), strict=True):
                for f in {f for w in _words(text) for f in memo[w]}:
                    if f not in seen:
                        size += ENTRY_BYTES + len(f)
                        seen[f] = [0, 0]
                    seen[f][0] += toxic
                    seen[f][1] += 1
                if size > COUNT_BYTES:
                    yield out()
                    seen, size = {}, 0
    yield out()


def likelihood_ratio(t: float, c: float, n_t: int, n_c: int) -> float:
    """Signed G^2 of a feature in ``t`` of ``n_t`` toxic and ``c`` of ``n_c`` clean rows."""
    def term(k: float, e: float) -> float:
        return k * math.log(k / e) if k else 0.0
    share = (t + c) / (n_t + n_c)
    g = 2 * (term(t, n_t * share) + term(c, n_c * share)
             + (term(n_t - t, n_t * (1 - share)) + term(n_c - c, n_c * (1 - share)) if share < 1 else 0.0))
    return g if t * n_c > c * n_t else -g


def mine_features(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[list[str], float]:
    """Features that mark toxic rows, best first, and the toxic share of the
    labelled rows. ``docs`` meets at most ``labelled`` ids, so these are
    broadcast."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out())
           .groupBy("doc_id").agg(F.max(F.col("toxic") == 1).alias("toxic")))
    sample = cut_lineage(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    both = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    n = both.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    n_t, n_c = (sum(r["n"] for r in n if r["toxic"] is v) for v in (True, False))
    if not n_t or not n_c:
        return [], (n_t / (n_t + n_c) if n_t + n_c else 0.0)
    counted = (both.select("text", "toxic").mapInArrow(_count, "feature string, t long, n long")
               .groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
               .where((F.col("t") >= MIN_ROWS) & (F.col("t") >= MIN_PRECISION * F.col("n"))).collect())
    ratio = {r["feature"]: likelihood_ratio(r["t"], r["n"] - r["t"], n_t, n_c) for r in counted}
    return sorted((f for f, g in ratio.items() if g >= MIN_RATIO), key=lambda f: (-ratio[f], f)), n_t / (n_t + n_c)


def voter_of(feature: str) -> int:
    half = VOTERS // 2
    return zlib.crc32(feature.encode()) % half + (0 if feature[0] == "w" else half)


def _vote(features: list[str]):
    voters = [voter_of(f) for f in features]

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _wanted(features)
        for b in (part for whole in batches for part in _slices(whole)):
            hits = [sorted(_numbers(memo, t)) for t in strings(b.column("text"))]
            masks = []
            for h in hits:
                m = 0
                for i in h:
                    m |= 1 << voters[i]
                masks.append(m)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), b.column("text_hash"), pa.array(masks, pa.int32()),
                 pa.array(hits, pa.list_(pa.int32()))], ["doc_id", "held_out", "text_hash", "mask", "hits"])
    return run


def label_model(masks: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 100):
    """(posterior of each mask, rates on toxic, rates on clean, correlations).

    A voter's weight is 1 / (1 + the sum of its positive correlations with
    the others given the class), so a group of voters that fire together
    counts about once."""
    fires = ((masks[:, None] >> np.arange(VOTERS)) & 1).astype(np.float64)
    n = counts.astype(np.float64)
    pi = min(max(prior, 1e-3), 0.5)
    toxic = np.where(fires.any(axis=1), 0.9, 0.01)
    weight, corr = np.ones(VOTERS), np.zeros((VOTERS, VOTERS))
    for turn in range(rounds):
        t, c = n * toxic, n * (1 - toxic)
        a = (t @ fires + 0.5) / (t.sum() + 1.0)
        b = np.minimum((c @ fires + 0.05) / (c.sum() + 1.0), a)     # voters speak for toxic
        if turn >= 5:                   # correlations given the class, over both classes
            cov = np.zeros((VOTERS, VOTERS))
            var = np.zeros(VOTERS)
            for mass, rate in ((t, a), (c, b)):
                d = fires - rate
                cov += (d * mass[:, None]).T @ d
                var += mass @ (d * d)
            corr = cov / np.maximum(np.sqrt(np.outer(var, var)), 1e-12)
            np.fill_diagonal(corr, 0.0)
            weight = 1.0 / (1.0 + np.maximum(corr, 0.0).sum(axis=1))
        ratio = fires * np.log(a / b) + (1 - fires) * np.log((1 - a) / (1 - b))
        odds = math.log(pi / (1 - pi)) + ratio @ weight
        new = 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))
        if turn > 6 and np.abs(new - toxic).max() < 1e-6:
            toxic = new
            break
        toxic = new
    return toxic, a, b, corr


def _row(hits: list[int], lexical: np.ndarray) -> tuple[float, float]:
    words = int(lexical[hits].sum()) if len(hits) else 0
    return math.log1p(words), math.log1p(len(hits) - words)


def fit_linear(hits: list[list[int]], goal: np.ndarray, weight: np.ndarray, lexical: np.ndarray,
               rounds: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient steps.
    Weights: bias, word hits, pattern hits, then one a feature."""
    m = len(lexical)
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.fromiter((i for h in hits for i in h), np.int64, len(row))
    dense = np.array([_row(h, lexical) for h in hits]).reshape(-1, 2)
    share = weight / weight.sum()
    w, last, theta = np.zeros(m + 3), np.zeros(m + 3), 1.0
    size = np.bincount(row, minlength=len(hits)) + 1 + (dense ** 2).sum(axis=1)
    step = 1.0 / (0.25 * float((share * size).sum()) + ridge)     # the trace bounds the curvature
    for _ in range(rounds):
        z = w[0] + dense @ w[1:3] + np.bincount(row, w[3:][col], minlength=len(hits))
        g = share * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - goal)
        grad = np.concatenate(([g.sum()], dense.T @ g, np.bincount(col, g[row], minlength=m)))
        grad[1:] += ridge * w[1:]
        new = w - step * grad
        after = (1 + math.sqrt(1 + 4 * theta * theta)) / 2
        w = new + (theta - 1) / after * (new - last)
        last, theta = new, after
    return last


class Model(NamedTuple):
    features: list[str]
    lexical: np.ndarray     # which features are words
    weights: np.ndarray     # of fit_linear

    def score(self, hits: list[int]) -> float:
        words, patterns = _row(hits, self.lexical)
        z = self.weights[0] + self.weights[1] * words + self.weights[2] * patterns + self.weights[3:][hits].sum()
        return 1.0 / (1.0 + math.exp(-min(max(z, -40.0), 40.0)))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, sample: int = SAMPLE) -> tuple[Model, DataFrame]:
    """The model and the written votes ``(doc_id, held_out, text_hash, mask,
    hits)`` of every row. The driver holds the model, two bounded samples and
    one count for each set of voters."""
    features, prior = mine_features(docs, labels, labelled)
    lexical = np.array([f[0] == "w" for f in features], bool)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    votes = cut_lineage(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _vote(features), f"doc_id {kind}, held_out boolean, text_hash long, mask int, hits array<int>"))
    learn = votes.where(~F.col("held_out"))
    sets = learn.groupBy("mask").agg(F.count(F.lit(1)).alias("n")).collect()        # 2^VOTERS rows at most
    if not any(r["mask"] for r in sets):
        w = np.zeros(len(features) + 3)
        w[0] = math.log(1e-3)
        return Model(features, lexical, w), votes
    masks, counts = (np.array([r[c] for r in sets], np.int64) for c in ("mask", "n"))
    posterior = dict(zip(masks.tolist(), label_model(masks, counts, prior)[0].tolist(), strict=True))
    hits, goal, weight = [], [], []
    for voted in (True, False):
        part = (learn.where((F.col("mask") != 0) == F.lit(voted)).orderBy(F.xxhash64("doc_id", "text_hash"))
                .limit(sample // 2).select("mask", "hits").collect())
        total = int(counts[(masks != 0) == voted].sum())
        hits += [list(r["hits"]) for r in part]
        goal += [posterior[r["mask"]] for r in part]
        weight += [total / len(part)] * len(part) if part else []
    return Model(features, lexical, fit_linear(hits, np.array(goal), np.array(weight), lexical)), votes


def _score_votes(model: Model):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(h) for h in b.column("hits").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **kw) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""
    model, votes = fit(docs, labels, **kw)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = votes.mapInArrow(_score_votes(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _filter_texts(model: Model, threshold: float):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _wanted(model.features)
        for b in (part for whole in batches for part in _slices(whole)):
            clean = [model.score(sorted(_numbers(memo, t))) < threshold for t in strings(b.column("text"))]
            yield b.filter(pa.array(clean, pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **kw) -> DataFrame:
    """``docs`` without the rows that are predicted toxic, scored and filtered
    where they are read: no text is shuffled."""
    model, _ = fit(docs, labels, **kw)
    return docs.mapInArrow(_filter_texts(model, threshold), docs.schema)
