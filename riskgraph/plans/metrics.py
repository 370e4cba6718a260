"""Classifier evaluation as aggregates: accuracy, confusion matrix normalised
by true class, ROC and precision-recall points.

Curves first aggregate to one row per distinct score, as it is; these rows are
summed up in ranges of scores (``operators/ranges.py``), so no task sees them all,
however many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.functions.exprs import r6
from riskgraph.operators.ranges import running_sums
from riskgraph.session import cut_lineage


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(r6(F.avg((F.col(label) == F.col(prediction)).cast("double"))).alias("accuracy"))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, predicted, cnt, rate) with rate = cnt / rows of that label."""
    c = pred.groupBy(F.col(label).cast("int").alias("label"),
                     F.col(prediction).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("cnt"))
    per_label = F.sum("cnt").over(Window.partitionBy("label"))
    return c.select("label", "predicted", "cnt", r6(F.col("cnt") / per_label).alias("rate"))


def _curve_base(pred: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tp, fp, P, N); rows without a score take no part."""
    s = cut_lineage(pred.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold"))
                    .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
                    .withColumn("neg", F.col("n") - F.col("pos")))
    total = s.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return running_sums(s, [F.col("threshold").desc()], tp="pos", fp="neg").select(
        "threshold", "tp", "fp", F.lit(total["P"] or 0).alias("P"), F.lit(total["N"] or 0).alias("N"))


def roc_points(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score threshold (predict 1 when score >= t)."""
    b = _curve_base(pred, label, score)
    return b.select("threshold", "tp", "fp",
                    r6(F.try_divide(F.col("tp").cast("double"), F.col("P"))).alias("tpr"),
                    r6(F.try_divide(F.col("fp").cast("double"), F.col("N"))).alias("fpr"))


def pr_points(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    b = _curve_base(pred, label, score)
    return b.select("threshold", "tp", "fp",
                    r6(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))).alias("precision"),
                    r6(F.try_divide(F.col("tp").cast("double"), F.col("P"))).alias("recall"))
