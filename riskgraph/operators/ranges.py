"""Numbering and running sums over a whole table, without a task that sees it all.

The rows are range partitioned in the wanted order, sorted inside and written with
their partition and place. A partition then numbers (or sums up) its own rows, and
what all partitions before it hold is added: one row a partition is all that is
gathered. The results do not depend on how the ranges fall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.session import cut_lineage

_ROW_BITS = 33          # monotonically_increasing_id: partition above, row in the partition below


def ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` written in ``order``, with the columns ``__part`` and ``__place``."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    return cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("__place", F.monotonically_increasing_id())
                       .withColumn("__part", F.shiftright("__place", _ROW_BITS)))


def before_parts(placed: DataFrame, **sums: Column) -> DataFrame:
    """``(__part, names)``: each sum over all partitions before."""
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per = placed.groupBy("__part").agg(*[c.alias(n) for n, c in sums.items()])         # a row a partition
    return per.select("__part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums])


def numbered(df: DataFrame, order: list, out: str = "n") -> DataFrame:
    """``df`` with each row's number in ``order``, from 0 (rows that are equal in
    the order get any of their numbers)."""
    placed = ranged(df, order)
    starts = before_parts(placed, __start=F.count(F.lit(1)))
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.join(F.broadcast(starts), "__part")
            .select(*df.columns, (F.col("__start") + row).alias(out)))


def running_sums(df: DataFrame, order: list, **sums: str) -> DataFrame:
    """``df`` with, for each ``name=column``, the sum of the column over the rows up
    to and with this one."""
    placed = ranged(df, order)
    starts = before_parts(placed, **{f"__s_{n}": F.sum(c) for n, c in sums.items()})
    own = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.select("*", *[F.sum(c).over(own).alias(f"__o_{n}") for n, c in sums.items()])
            .join(F.broadcast(starts), "__part")
            .select(*df.columns, *[(F.col(f"__s_{n}") + F.col(f"__o_{n}")).alias(n) for n in sums]))
