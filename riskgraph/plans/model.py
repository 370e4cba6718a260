"""Supervised model on the feature table: seeded hash split, random forest
(``operators/forest.py``), permutation importance and the high-probability
shortlist. The feature table never leaves Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.operators import forest
from riskgraph.operators.forest import Forest
from riskgraph.operators.ranges import numbered
from riskgraph.session import cut_lineage

# The model and split parameters of the analysis.
N_TREES = 500
MAX_DEPTH = 5
SEED = 0
TEST_PERCENT = 20
SHORTLIST_P = 0.88
IMPORTANCE_REPEATS = 5


def split(df: DataFrame, test_percent: int = TEST_PERCENT, seed: int = SEED, key: str = "guid"):
    """Deterministic train/test split by a seeded hash of the key: stable
    under any partitioning or re-execution (randomSplit is not)."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100))
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


def fit_forest(train: DataFrame, features: list[str], label: str = "label", **kw) -> Forest:
    """The analysis' forest: 500 trees of depth 5, bootstrap, balanced classes."""
    return forest.fit_forest(train, features, label, **{"trees": N_TREES, "depth": MAX_DEPTH, "seed": SEED, **kw})


def permutation_importance(predict: Callable[[DataFrame], DataFrame], df: DataFrame, features: list[str],
                           label: str = "label", repeats: int = IMPORTANCE_REPEATS, seed: int = SEED,
                           key: str = "guid") -> DataFrame:
    """Mean accuracy drop when one feature column is permuted, per feature,
    as |mean| over ``repeats`` permutations, ranked. ``predict`` adds a column
    ``prediction``.

    A permutation is over all rows, at every size: rows are numbered by ``key``, and
    once more for each repeat by the md5 of seed, repeat and key; the row of the same
    number in that order gives the permuted values (all features' at once, one
    column is replaced at a time). Both numberings are by ranges, the donors join
    on the number, and all feature x repeat copies are scored in one job.
    """
    rows = cut_lineage(df.select(key, label, *features))
    n = rows.count()
    reps = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__r")
    natural = numbered(rows, [key], "__n").select(key, label, *features, "__n", reps)
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__r").cast("string"), F.col(key).cast("string")))
    donors = numbered(rows.select(key, *[F.col(c).alias(f"__d_{c}") for c in features], reps).withColumn("__h", mixed),
                      ["__r", "__h", key], "__m")
    donors = donors.select("__r", (F.col("__m") - F.col("__r") * F.lit(n)).alias("__n"), *[f"__d_{c}" for c in features])
    # __f = -1 is the unpermuted copy: the baseline is scored in the same job.
    copies = natural.join(donors, ["__r", "__n"]).select(
        "*", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))).alias("__f"))
    copies = copies.select(key, label, "__r", "__f", *[
        F.when(F.col("__f") == i, F.col(f"__d_{c}")).otherwise(F.col(c)).alias(c)
        for i, c in enumerate(features)])
    acc = predict(copies).groupBy("__f", "__r").agg(
        F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("acc"))
    # (features + 1) x repeats rows: the baseline is spread with a window.
    base = F.max(F.when(F.col("__f") == -1, F.col("acc"))).over(Window.partitionBy("__r"))
    drops = acc.withColumn("drop", base - F.col("acc")).where(F.col("__f") >= 0)
    names = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("__f") + 1)
    imp = drops.groupBy("__f").agg(F.abs(F.avg("drop")).alias("importance"))
    return imp.select(names.alias("feature"), F.round("importance", 6).alias("importance")) \
        .orderBy(F.col("importance").desc(), F.col("feature"))


def shortlist(pred: DataFrame, p: float = SHORTLIST_P, label: str = "label") -> DataFrame:
    """High-probability predictions on rows labelled 0."""
    return pred.where((F.col("probability") > p) & (F.col(label) == 0))
