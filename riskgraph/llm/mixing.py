"""Mixing sources to target weights: capped water-filling over the sources'
sizes, then a seeded sample of whole and fractional repetitions.

* A document's size is its number of words (null text: 0).
* Sources are ordered by code point, null last, and weigh 1, 2, 3, 1, 2, 3,
  ... (``weights``). Together they share ``budget`` times all sizes; a source
  is clamped at ``max_epochs`` times its own size and the excess goes to the
  others by weight, again and again until no target is above its clamp.
* A source with target ``t`` and size ``s`` takes ``t // s`` whole
  repetitions of each document and, for what remains, whole documents in a
  seeded order (md5 of seed and doc_id) as far as the remainder goes; the
  document on which it ends gives a fractional repetition, its first words.
  So a source's taken words miss its target by less than one word.

The order is not sorted as a whole: words are summed per source and leading
digits of the md5 (4,096 cells, summed before the shuffle), the cell on which
the remainder ends is found, then the next digits inside that cell, and only
the documents of the last cell are put in order. No source, however large,
meets in one task.

Defined cases: an empty table gives an empty result; a document without words
takes 0; a source whose documents are all empty has target 0; a null source
is a source of its own; rows that repeat a doc_id are separate documents
(equal rows tie and are taken as one run in either order); a null doc_id is
ordered as the text ``null``; extra columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from riskgraph.llm.common import WORD, cut_lineage

SEED = "mix-1"
DIGITS = 3          # hex digits a level: 4,096 cells
LEVELS = 2          # then one window over 1 / 16,777,216 of a source


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def ranked_sources(per_source: DataFrame) -> DataFrame:
    """``pos`` of each source in code-point order, null last, from 1. Sources
    are range-partitioned and numbered per partition; only the partitions'
    counts (at most the number of shuffle partitions) are summed ahead."""
    null_last = [F.col("source").isNull(), F.col("source")]
    part = cut_lineage(per_source.repartitionByRange(*null_last).withColumn("part", F.spark_partition_id()))
    ahead = (part.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
             .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead")))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*null_last))
    return part.withColumn("rn", within).join(ahead, "part").withColumn("pos", F.col("rn") + F.col("ahead"))


def targets(per_source: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
            budget: float | None = None) -> DataFrame:
    """``(source, source_size, weight, target)`` by water-filling over
    ``(source, source_size)``. Each round one aggregate row comes to the
    driver; a round clamps at least one more source or is the last."""
    cycle = F.array(*[F.lit(w) for w in weights])
    s = cut_lineage(ranked_sources(per_source).select(
        "source", "source_size",
        F.element_at(cycle, ((F.col("pos") - 1) % len(weights) + 1).cast("int")).cast("long").alias("weight")))
    total = s.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    if budget is not None:
        total = int(budget * total)
    cap, clamped, n = F.col("source_size") * max_epochs, F.lit(False), 0
    while True:
        row = s.agg(F.sum(F.when(clamped, cap).otherwise(0)).alias("words"),
                    F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("weight")).first()
        left, weight = total - (row["words"] or 0), row["weight"] or 0
        above = clamped | (F.col("weight") * F.lit(left) > cap * F.lit(weight))
        more = s.agg(F.count_if(above).alias("n")).first()["n"] if weight else n
        if more == n:
            break
        clamped, n = above, more
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weight or 1))
    return s.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(share))


def _ending_cell(rows: DataFrame, need: DataFrame, level: int) -> DataFrame:
    """For each source of ``need`` (``_s, _prefix, _rest``): the cell of the
    next digits in which ``_rest`` words end; ``_prefix`` is extended by it
    and ``_rest`` reduced by the words of the cells before it."""
    inside = rows.join(need.select("_s", "_prefix"), F.col("source").eqNullSafe(F.col("_s"))
                       & (F.substring("k", 1, DIGITS * level) == F.col("_prefix")))
    cells = (inside.groupBy("source", F.substring("k", 1, DIGITS * (level + 1)).alias("cell"))
             .agg(F.sum("size").alias("words")))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("cell")) - F.col("words")
    hit = (cells.withColumn("before", before)
           .join(need.select("_s", "_rest"), F.col("source").eqNullSafe(F.col("_s")))
           .where((F.col("before") <= F.col("_rest")) & (F.col("_rest") < F.col("before") + F.col("words"))))
    return cut_lineage(hit.select(F.col("source").alias("_s"), F.col("cell").alias("_prefix"),
                                  (F.col("_rest") - F.col("before")).alias("_rest")))


def source_cuts(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                budget: float | None = None, seed: str = SEED) -> DataFrame:
    """One written row a source: ``(_s, _source_size, _target, _whole,
    _prefix, _in_cell)``. Documents whose key starts before ``_prefix`` get
    one repetition above ``_whole``, those after it none, those in it share
    ``_in_cell`` words."""
    rows = cut_lineage(docs.select("source", _key(seed).alias("k"), _size().alias("size")))
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs, budget)
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = cut_lineage(goal.select(F.col("source").alias("_s"), F.col("source_size").alias("_source_size"),
                                   F.col("target").alias("_target"), whole.alias("_whole"))
                       .withColumn("_goal_rest", (F.floor("_target") - F.col("_whole") * F.col("_source_size")).cast("long")))
    need = goal.where(F.col("_goal_rest") > 0).select("_s", F.lit("").alias("_prefix"), F.col("_goal_rest").alias("_rest"))
    for level in range(LEVELS):
        need = _ending_cell(rows, need, level)
    return cut_lineage(goal.drop("_goal_rest").join(
        need.select(F.col("_s").alias("_s2"), "_prefix", F.col("_rest").alias("_in_cell")),
        F.col("_s").eqNullSafe(F.col("_s2")), "left").drop("_s2"))


def _sided(docs: DataFrame, cuts: DataFrame, seed: str) -> DataFrame:
    """``docs`` with its source's cut and ``_side``: -1 before the cell in
    which its source ends, 0 in it, 1 after it. ``cuts`` has a row a source
    and its true file size, by which Spark picks the join."""
    d = docs.withColumn("_k", _key(seed)).join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left")
    mine = F.substring("_k", 1, DIGITS * LEVELS)
    return d.withColumn("_side", F.when(F.col("_prefix").isNull() | (mine > F.col("_prefix")), 1)
                        .when(mine < F.col("_prefix"), -1).otherwise(0))


def _in_cell(cell: DataFrame) -> DataFrame:
    """``_part``: the words that each document of an ending cell (``_size``
    known) gives above the whole repetitions."""
    w = (Window.partitionBy("source").orderBy("_k", "doc_id", "_size")
         .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum("_size").over(w), F.lit(0))
    return cell.withColumn("_part", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_in_cell") - before)))


def plan_mix(docs: DataFrame, seed: str = SEED, **kw) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every
    document; ``taken`` counts the words of its repetitions."""
    cuts = source_cuts(docs, seed=seed, **kw)
    d = cut_lineage(_sided(docs.select("doc_id", "source", _size().alias("_size")), cuts, seed))
    clear = d.where("_side != 0").withColumn("_part", F.when(F.col("_side") < 0, F.col("_size")).otherwise(0))
    both = clear.unionByName(_in_cell(d.where("_side = 0")))
    return both.select("doc_id", "source", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                       F.col("_target").alias("target"),
                       (F.col("_size") * F.col("_whole") + F.col("_part")).alias("taken"))


@F.pandas_udf(StringType())
def _first_words(text: pd.Series, n: pd.Series) -> pd.Series:
    """The text up to the end of its n-th word (one document a source)."""
    def head(t: str, k: int) -> str:
        end = 0
        for i, m in enumerate(re.finditer(WORD, t)):
            if i == k:
                break
            end = m.end()
        return t[:end]
    return pd.Series([head(t or "", int(k)) for t, k in zip(text, n, strict=True)], dtype=object)


def mix(docs: DataFrame, seed: str = SEED, **kw) -> DataFrame:
    """The mixed corpus, columns as ``docs``: whole repetitions as equal rows
    and, where a source ends inside a document, one row with that document's
    first words. The texts are not shuffled: each row finds its source's cut,
    and only the documents of the ending cells are put in order. A document
    that takes nothing is absent."""
    cuts = source_cuts(docs, seed=seed, **kw)
    d = _sided(docs, cuts, seed)
    clear = d.where("_side != 0").withColumn("_reps", F.col("_whole") + (F.col("_side") < 0).cast("long"))
    cell = _in_cell(d.where("_side = 0").withColumn("_size", _size()))
    whole_part = (F.col("_part") == F.col("_size")) & (F.col("_size") > 0)
    kept = cell.withColumn("_reps", F.col("_whole") + whole_part.cast("long"))
    copies = F.explode(F.sequence(F.lit(0), F.col("_reps").cast("int")))
    out = [*docs.columns]
    whole = clear.select(*out, "_reps").unionByName(kept.select(*out, "_reps")).withColumn("_copy", copies).where("_copy > 0")
    cut = cell.where("_part > 0 and _part < _size").withColumn("text", _first_words("text", "_part"))
    if "n_chars" in out:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return whole.select(*out).unionByName(cut.select(*out))
