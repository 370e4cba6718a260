"""The forest under any layout, importance of a known scorer, exact curves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph.operators import forest
from riskgraph.operators.ranges import numbered, running_sums
from riskgraph.plans import metrics, model


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    a, b, c = rng.integers(0, 40, 3000), rng.normal(size=3000), rng.integers(0, 2, 3000)
    y = ((a > 25) & (b > -0.5)) | (rng.random(3000) < 0.03)
    rows = [(i, int(a[i]), float(b[i]) if i % 50 else None, int(c[i]), 1, int(y[i])) for i in range(3000)]
    return spark.createDataFrame(rows, "guid long, a int, b double, c int, same int, label int")


def test_the_forest_is_the_same_on_1_8_and_64_partitions(spark, table):
    kw = {"features": ["a", "b", "c", "same"], "trees": 25, "depth": 4}
    models = [forest.fit_forest(table.repartition(n, "guid").orderBy(F.rand(n)), partitions=n, **kw) for n in (1, 8, 64)]
    for m in models[1:]:
        assert (m.feature == models[0].feature).all() and (m.cut == models[0].cut).all()
        assert (m.p == models[0].p).all()
    p = {r["guid"]: r["probability"] for r in models[0].score(table).collect()}
    assert p == {r["guid"]: r["probability"] for r in models[2].score(table.repartition(5)).collect()}
    good = models[0].score(table).select(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert good > 0.93
    assert 3 not in models[0].feature                       # a feature that does not vary is never split on


def test_rows_are_drawn_as_often_as_poisson_says():
    h = np.random.default_rng(1).integers(-2**63, 2**63, 200_000)
    n = forest.times_drawn(h, 0, 3)
    assert abs(n.mean() - 1) < 0.02 and abs((n == 0).mean() - np.exp(-1)) < 0.01 and abs(n.var() - 1) < 0.03
    assert (forest.times_drawn(h, 0, 4) != n).mean() > 0.4


def test_best_split_equals_a_search_over_all():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sums, weight = rng.integers(0, 4, (1, 2, 6, 2)), np.array([0.7, 2.5])
        if not sums[0, 0].sum():
            continue
        sums[0, 1] = sums[0, 0][rng.permutation(6)]
        def gini(part):
            w = part.sum(axis=0) * weight
            return 2 * w[0] * w[1] / w.sum() if w.sum() else 0.0
        want = max((round(gini(s) - gini(s[:b + 1]) - gini(s[b + 1:]), 9), -j, -b)
                   for j, s in enumerate(sums[0]) for b in range(5) if s[:b + 1].sum() and s[b + 1:].sum())
        choice, cut, *_ = forest.best_splits(sums, weight)
        if want[0] > 0:
            assert (choice[0], cut[0]) == (-want[1], -want[2])
        else:
            assert choice[0] == -1


def test_one_class_or_no_varying_feature(spark, table):
    zero = forest.fit_forest(table.where("label = 0"), ["a"], trees=3)
    assert {r["probability"] for r in zero.score(table).collect()} == {0.0}
    flat = forest.fit_forest(table, ["same"], trees=3)
    assert {r["probability"] for r in flat.score(table).collect()} == {0.5}


def test_importance_is_that_of_a_global_permutation(spark, table):
    import hashlib
    rows = {r["guid"]: r for r in table.collect()}
    got = {r["feature"]: r["importance"] for r in model.permutation_importance(
        lambda d: d.withColumn("prediction", (F.col("a") > 25).cast("int")), table.repartition(7), ["a", "c"], repeats=3).collect()}
    keys, drops = sorted(rows), []
    for r in range(3):
        donors = sorted(keys, key=lambda g: (hashlib.md5(f"0:{r}:{g}".encode()).hexdigest(), g))
        base = np.mean([(rows[g]["a"] > 25) == rows[g]["label"] for g in keys])
        drops.append(base - np.mean([(rows[d]["a"] > 25) == rows[g]["label"] for g, d in zip(keys, donors)]))
    assert got == {"a": round(abs(float(np.mean(drops))), 6), "c": 0.0}


def test_curves_keep_every_distinct_score(spark):
    # 200,000 scores that differ by less than 1e-6
    n = 200_000
    df = spark.range(n).select((F.lit(0.5) + F.col("id") * F.lit(1e-9)).alias("score"),
                               (F.col("id") % 3 == 0).cast("int").alias("label"))
    roc = metrics.roc_points(df)
    got = roc.agg(F.count(F.lit(1)).alias("n"), F.max("tp").alias("tp"), F.max("fp").alias("fp")).first()
    assert got["n"] == n and got["tp"] == -(-n // 3) and got["fp"] == n - -(-n // 3)
    some = roc.where(F.col("tp") + F.col("fp") == 1000).first()
    assert some["threshold"] == pytest.approx(0.5 + (n - 1000) * 1e-9, abs=1e-12)


def test_no_task_sums_up_the_whole_curve(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("score"), F.lit(1).alias("label"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per = metrics.pr_points(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert max(r["count"] for r in per) < 70_000


def test_numbers_and_sums_equal_a_window_over_all(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 11).alias("x")).repartition(6)
    got = {r["k"]: (r["n"], r["s"]) for r in running_sums(numbered(df, ["k"]), [F.col("k").desc()], s="x").collect()}
    rows, s = sorted((r["k"], r["x"]) for r in df.collect()), 0
    want = {}
    for i, (k, x) in reversed(list(enumerate(rows))):
        s += x
        want[k] = (i, s)
    assert got == want
