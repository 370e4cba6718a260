"""A random forest whose model depends on its data and seed alone.

Every tree sees every training row a number of times that is Poisson(1)
distributed: the bootstrap of rows without a fixed sample size (Oza, Russell:
"Online Bagging and Boosting", 2001). The number comes from a hash of the row's key
and the tree, not from a generator that runs along a partition, so it is the same
wherever the row lies. All that is added up are whole numbers: class weights are
applied to the sums. So the same rows give the same forest on 1 or on 1,000
partitions, in any order.

All trees grow together, a level at a time, on binned features (at most ``BINS``
values each, cut at quantiles of the training rows). A task adds up, for each tree
and each node of the level, the classes by bin of the features that the node may
split on; these histograms (non-zero cells alone) meet by tree, where the split of
least weighted Gini impurity is chosen; the driver gets one row a tree and node,
the model itself. No row moves between levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.ranges import running_sums
from riskgraph.session import cut_lineage, importable

BINS = 32
PARTITIONS = 64                 # of the training rows, at least
ROWS_PER_PARTITION = 500_000
SLICE = 20_000                  # rows that are scored at a time
KNOWN = 100_000                 # scores of rows alike that are at hand
MASK_ROWS = 512                 # rows whose masks of all trees are kept at a time
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


class Forest(NamedTuple):
    features: list[str]
    edges: list[np.ndarray]     # per feature: bin b holds the values up to edges[b], the last those above
    feature: np.ndarray         # trees x nodes, -1: a leaf; children of node i are 2i and 2i + 1, the root is 1
    cut: np.ndarray             # trees x nodes: bins up to it go left
    p: np.ndarray               # trees x nodes: weighted share of class 1

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (mean over the trees) and ``prediction``."""
        importable(df.sparkSession)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return (df.mapInArrow(_scored(self), schema + ", probability double")
                .withColumn("prediction", (F.col("probability") > 0.5).cast("double")))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _seeded(seed: int, tree: int) -> np.uint64:
    return _mix(np.array([seed * 1_000_003 + tree + 1], np.uint64))[0]


def times_drawn(key_hash: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in a tree's sample."""
    u = (_mix(key_hash.view(np.uint64) ^ _seeded(seed, tree)) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(_POISSON, u, side="right")


def allowed(seed: int, tree: int, nodes: np.ndarray, usable: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` features that each node may split on: nodes x k."""
    mixed = _mix(nodes[:, None].astype(np.uint64) * np.uint64(8191) + usable[None, :].astype(np.uint64)
                 ^ _seeded(seed + 7, tree))
    return usable[np.argsort(mixed, axis=1, kind="stable")[:, :k]]


def quantile_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Exact cut values per feature: the largest value of each of ``bins`` equal
    shares of the rows, without the largest of all. Distinct values are counted and
    summed up in ranges; ``features x bins`` rows reach the driver."""
    one = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in features])).alias("f", "v")) \
        .where(F.col("v").isNotNull())
    counts = one.groupBy("f", "v").agg(F.count(F.lit(1)).alias("c"))
    cum = running_sums(counts, ["f", "v"], upto="c")
    size = one.groupBy("f").agg(F.count(F.lit(1)).alias("rows")).collect()              # a row a feature
    rows, start, at = {r["f"]: r["rows"] for r in size}, {}, 0
    for f in range(len(features)):
        start[f] = at
        at += rows.get(f, 0)
    first = F.create_map(*[F.lit(x) for f in range(len(features)) for x in (f, start[f])])
    n = F.create_map(*[F.lit(x) for f in range(len(features)) for x in (f, max(rows.get(f, 0), 1))])
    share = F.floor((F.col("upto") - F.col("c") - F.element_at(first, F.col("f"))) * bins / F.element_at(n, F.col("f")))
    got = cum.groupBy("f", share.alias("share")).agg(F.max("v").alias("v")).collect()
    out = []
    for f in range(len(features)):
        values = np.array(sorted(r["v"] for r in got if r["f"] == f), np.float64)
        out.append(values[:-1])
    return out


def _matrix(b: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """Rows x features; a null is below all values."""
    cols = [b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features]
    x = np.column_stack(cols) if cols else np.zeros((b.num_rows, 0))
    return np.where(np.isnan(x), -np.inf, x)


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)


def _binned(features: list[str], edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.ascontiguousarray(_bins(_matrix(b, features), edges))
            yield pa.RecordBatch.from_arrays(
                [b.column("h"), b.column("y"), pa.array([r.tobytes() for r in rows], pa.binary())], ["h", "y", "bins"])
    return run


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after ``levels`` steps; rows that ended in a leaf stay there."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        right = bins[rows, np.maximum(f, 0)] > cut[node]
        node = np.where(f < 0, node, 2 * node + right)
    return node


def _histograms(model: Forest, level: int, seed: int, usable: np.ndarray, k: int, bins: int):
    width = len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("h").to_numpy(), b.column("y").to_numpy(), np.frombuffer(
            b"".join(b.column("bins").to_pylist()), np.uint8).reshape(-1, width)) for b in batches if b.num_rows]
        if not parts:
            return
        h, y, x = (np.concatenate(c) for c in zip(*parts, strict=True))
        nodes = np.arange(1 << level, 2 << level)
        out = []
        for tree in range(len(model.feature)):
            drawn = times_drawn(h, seed, tree)
            at = _walk(x, model.feature[tree], model.cut[tree], level)
            rows = np.flatnonzero((drawn > 0) & (at >= nodes[0]))
            local = at[rows] - nodes[0]
            choice = allowed(seed, tree, nodes, usable, k)[local]               # rows x k
            cell = ((local[:, None] * k + np.arange(k)) * bins + x[rows[:, None], choice]) * 2 + y[rows, None]
            sums = np.bincount(cell.ravel(), np.repeat(drawn[rows], k), len(nodes) * k * bins * 2).astype(np.int64)
            some = np.flatnonzero(sums)
            out.append((tree, some.astype("<i4").tobytes(), sums[some].astype("<i8").tobytes()))
        trees, cells, sums = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int32()), pa.array(cells, pa.binary()),
                                          pa.array(sums, pa.binary())], ["tree", "cells", "sums"])
    return run


def best_splits(sums: np.ndarray, weight: np.ndarray):
    """Per node of ``sums`` (nodes x choices x bins x classes): choice, bin, the
    node's share of class 1 and those of its two sides; choice -1 where no split
    makes it purer."""
    w = sums * weight
    left = np.cumsum(w, axis=2)[:, :, :-1]
    total = w.sum(axis=2)[:, :, None]
    right = total - left
    n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), total.sum(axis=3)
    valid = (np.cumsum(sums, axis=2)[:, :, :-1].sum(axis=3) > 0) & \
        (sums.sum(axis=2)[:, :, None].sum(axis=3) - np.cumsum(sums, axis=2)[:, :, :-1].sum(axis=3) > 0)

    def impurity(part: np.ndarray, size: np.ndarray) -> np.ndarray:
        return 2 * part[..., 0] * part[..., 1] / np.where(size > 0, size, 1)
    gain = impurity(total, n) - impurity(left, n_left) - impurity(right, n_right)
    gain = np.where(valid, np.round(gain, 9), 0.0)
    flat = gain.reshape(len(gain), gain.shape[1] * gain.shape[2])
    best = flat.argmax(axis=1)                                                  # the first of equal ones
    choice, cut = np.unravel_index(best, gain.shape[1:])
    rows = np.arange(len(gain))

    def share(part: np.ndarray) -> np.ndarray:
        size = part.sum(axis=-1)
        return part[..., 1] / np.where(size > 0, size, 1)
    found = flat[rows, best] > 0
    return (np.where(found, choice, -1), cut, share(total[:, 0, 0]), share(left[rows, choice, cut]),
            share(right[rows, choice, cut]))


_SPLIT = "tree int, node int, feature int, cut int, p double, p_left double, p_right double"


def _splits(level: int, seed: int, usable: np.ndarray, k: int, bins: int, weight: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        tree, nodes = table.column("tree")[0].as_py(), np.arange(1 << level, 2 << level)
        sums = np.zeros(len(nodes) * k * bins * 2, np.int64)
        for cells, part in zip(table.column("cells").to_pylist(), table.column("sums").to_pylist(), strict=True):
            sums[np.frombuffer(cells, "<i4")] += np.frombuffer(part, "<i8")     # a cell is once in a part
        sums = sums.reshape(len(nodes), k, bins, 2)
        here = np.flatnonzero(sums[:, 0].sum(axis=(1, 2)))
        choice, cut, p, left, right = best_splits(sums[here], weight)
        feature = np.where(choice < 0, -1, allowed(seed, tree, nodes, usable, k)[here, np.maximum(choice, 0)])
        return pa.table([pa.array(np.full(len(here), tree), pa.int32()), pa.array(nodes[here], pa.int32()),
                         pa.array(feature, pa.int32()), pa.array(cut, pa.int32()), pa.array(p), pa.array(left),
                         pa.array(right)], ["tree", "node", "feature", "cut", "p", "p_left", "p_right"])
    return run


def fit_forest(train: DataFrame, features: list[str], label: str = "label", trees: int = 500, depth: int = 5,
               seed: int = 0, key: str = "guid", bins: int = BINS, partitions: int | None = None) -> Forest:
    """``label`` is 0 or 1. Classes weigh alike in total (n / (2 n_class)); a node
    may split on the square root of the number of features that vary. Rows are
    known by ``key``: equal keys are drawn alike."""
    importable(train.sparkSession)
    train = cut_lineage(train.select(F.xxhash64(key).alias("h"), F.col(label).cast("tinyint").alias("y"),
                                     *[F.col(c).cast("double").alias(c) for c in features]))
    n = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    weight = np.array([total / (2 * n[c]) if n.get(c) else 0.0 for c in (0, 1)])
    edges = quantile_edges(train, features, bins)
    usable = np.array([i for i, e in enumerate(edges) if len(e)], np.int64)
    shape = (trees, 2 << depth)
    model = Forest(features, edges, np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape))
    model.p[:, 1] = 0.5 if len(n) > 1 else float(1 in n)
    if not len(usable) or len(n) < 2:
        return model
    k = max(1, int(math.sqrt(len(usable))))
    parts = partitions or max(PARTITIONS, -(-total // ROWS_PER_PARTITION))
    rows = cut_lineage(train.mapInArrow(_binned(features, edges), "h long, y tinyint, bins binary").repartition(parts, "h"))
    for level in range(depth):
        got = (rows.mapInArrow(_histograms(model, level, seed, usable, k, bins), "tree int, cells binary, sums binary")
               .groupBy("tree").applyInArrow(_splits(level, seed, usable, k, bins, weight), _SPLIT).collect())
        for r in got:                                                           # a row a tree and node
            model.p[r["tree"], r["node"]] = r["p"]
            if r["feature"] >= 0:
                model.feature[r["tree"], r["node"]], model.cut[r["tree"], r["node"]] = r["feature"], r["cut"]
                model.p[r["tree"], 2 * r["node"]], model.p[r["tree"], 2 * r["node"] + 1] = r["p_left"], r["p_right"]
        if all(r["feature"] < 0 for r in got):
            break
    return model


def _leaf_masks(model: Forest) -> tuple[list[np.ndarray], np.ndarray]:
    """Per feature: for each bin and tree, the leaves that a row of that bin can reach
    as bits, from the left; and each tree's values by leaf: trees x 2^depth. A row
    is in the first leaf that is left by all its features (Lucchese et al.:
    "QuickScorer", 2015). A leaf above the last level is the leaf at its left edge."""
    trees, depth = len(model.feature), model.feature.shape[1].bit_length() - 2
    n = 1 << depth
    masks = [np.full((len(e) + 1, trees), (1 << n) - 1, np.uint64) for e in model.edges]
    values, rows = np.zeros((trees, n)), np.arange(trees)
    at = np.tile(np.arange(n, 2 * n), (trees, 1))           # where each last node's path ends
    for level in range(depth - 1, -1, -1):
        for node in range(1 << level, 2 << level):
            width = n >> level                              # leaves under the node, the first of them
            first = node * width - n
            ends = model.feature[:, node] < 0
            at[ends, first:first + width] = node
            left = np.uint64(((1 << (width // 2)) - 1) << first)
            for tree in rows[~ends]:
                f = model.feature[tree, node]
                masks[f][model.cut[tree, node] + 1:, tree] &= ~left
    values = model.p[rows[:, None], at]
    return masks, values


def _first_bit(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x & (~x + x.dtype.type(1))) - x.dtype.type(1))


def _alike_once(total, edges: list[np.ndarray]):
    """``total``, a score by rows of bins, where rows of the same bins are scored once;
    the scores of up to ``KNOWN`` kinds of rows are at hand from one call to the next."""
    sizes = [len(e) + 1 for e in edges]
    if not sizes or math.prod(sizes) >= 1 << 63:
        return total
    factor = np.cumprod([1, *sizes[:-1]], dtype=np.int64)
    known, score = np.zeros(0, np.int64), np.zeros(0)

    def run(bins: np.ndarray) -> np.ndarray:
        nonlocal known, score
        keys, first, where = np.unique(bins @ factor, return_index=True, return_inverse=True)
        at = np.searchsorted(known, keys)
        hit = np.append(known, -1)[at] == keys
        out = np.empty(len(keys))
        out[hit], new = score[at[hit]], np.flatnonzero(~hit)
        if len(new):
            out[new] = total(bins[first[new]])
            if len(known) + len(new) > KNOWN:
                known, score = keys, out
            else:
                known, score = np.insert(known, at[new], keys[new]), np.insert(score, at[new], out[new])
        return out[where]
    return run


def _scored(model: Forest):
    depth = model.feature.shape[1].bit_length() - 2

    def walked(bins: np.ndarray) -> np.ndarray:
        p = np.zeros(len(bins))
        for feature, cut, share in zip(model.feature, model.cut, model.p, strict=True):
            p += share[_walk(bins, feature, cut, depth)]
        return p

    def masked():
        masks, values = _leaf_masks(model)
        kind, (trees, n) = np.uint32 if depth <= 5 else np.uint64, values.shape
        used = [(f, m.astype(kind)) for f, m in enumerate(masks) if len(m) > 1 and (m != m[0]).any()]
        values, base = values.ravel(), np.arange(trees) * n

        def run(bins: np.ndarray) -> np.ndarray:
            out = np.zeros(len(bins))
            for at in range(0, len(bins), MASK_ROWS):
                part = bins[at:at + MASK_ROWS]
                if len(part) == 1:                          # numpy adds up a single column in another order
                    part = np.repeat(part, 2, axis=0)
                reach = np.full((len(part), trees), (1 << n) - 1, kind)
                for f, m in used:
                    reach &= m[part[:, f]]
                # added up tree by tree, as if the trees were walked
                out[at:at + MASK_ROWS] = np.add.reduce(values[np.ascontiguousarray((_first_bit(reach) + base).T)], axis=0)[:len(out) - at]
            return out
        return run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _alike_once(masked() if depth <= 6 else walked, model.edges)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                p = total(_bins(_matrix(b, model.features), model.edges))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(p / len(model.feature))], [*b.schema.names, "probability"])
    return run
