"""Group values joined back to the members of the group, safe against groups
of any size.

An aggregate on a key joined back on the same key puts all rows of the key
into one task, and AQE cannot split that partition when the aggregate lies
right below the join. Here the aggregate (one row a key, map-side combined) is
written with the number of rows of each key. The keys that are heavy by that
count, at most ``MAX_HEAVY`` by construction, are dealt over ``salts`` partial
keys: their member rows get a salt from the row itself, their one aggregate
row is repeated once a salt. All other keys join as usual. The list of heavy
keys is the only thing that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.session import cut_lineage, cut_lineage_observed, shuffle_partitions

MAX_HEAVY = 1_000
MIN_HEAVY_ROWS = 100_000


def heavy_keys(counts: DataFrame, keys: list[str], n: str = "__n", max_heavy: int = MAX_HEAVY,
               min_rows: int = MIN_HEAVY_ROWS) -> DataFrame | None:
    """The keys of a written ``counts(keys, n)`` that hold more than a
    ``max_heavy``-th of all rows and more than ``min_rows``: at most
    ``max_heavy`` rows. None if there is none."""
    s = counts.agg(F.sum(n).alias("total"), F.max(n).alias("top")).first()
    limit = max(min_rows, -(-(s["total"] or 0) // max_heavy))
    if (s["top"] or 0) <= limit:
        return None
    return cut_lineage(counts.where(F.col(n) > limit).select(*keys))


def _matches(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def salted_join(rows: DataFrame, side: DataFrame, keys: list[str], heavy: DataFrame | None,
                how: str = "inner", salts: int | None = None) -> DataFrame:
    """``rows`` joined to ``side`` on ``keys``; ``heavy`` are the keys, or values
    of some of the key columns, of which ``rows`` holds very many (see
    ``heavy_keys``). The result has the columns of ``rows`` and the other columns
    of ``side``. Null keys match nothing in an inner join, as in any equi-join."""
    if heavy is None:
        return rows.join(side, keys, how)
    salts = salts or shuffle_partitions(rows.sparkSession)
    by = heavy.columns
    drop = [f"__h{i}" for i in range(len(by))] + ["__heavy"]
    mark = F.broadcast(heavy.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(by)],
                                    F.lit(True).alias("__heavy")))
    hit = _matches(by, drop[:-1])
    # from the row and the partition it comes from, both the same when a lost task runs
    # again; equal rows part by the latter
    spread = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = (rows.join(mark, hit, "left")
            .withColumn("__salt", F.when(F.col("__heavy"), spread).otherwise(F.lit(0))).drop(*drop))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    right = (side.join(mark, hit, "left")
             .withColumn("__salt", F.explode(F.when(F.col("__heavy"), all_salts).otherwise(F.array(F.lit(0)))))
             .drop(*drop))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def join_back(rows: DataFrame, keys: list[str], how: str = "inner", max_heavy: int = MAX_HEAVY,
              min_rows: int = MIN_HEAVY_ROWS, salts: int | None = None, keep: Column | None = None,
              **values: Column) -> DataFrame:
    """``rows`` with the aggregates ``values`` of their group of ``keys``.
    ``keep`` filters the groups (on the named values) before the join: with
    ``how="left"`` the rows of other groups get nulls, with "inner" they go.
    ``rows`` is read twice (for the aggregate and for the join)."""
    sums, _ = cut_lineage_observed(rows.groupBy(*keys).agg(*[c.alias(k) for k, c in values.items()],
                                                           F.count(F.lit(1)).alias("__n")), n=F.count(F.lit(1)))
    heavy = heavy_keys(sums, keys, max_heavy=max_heavy, min_rows=min_rows)
    side = sums if keep is None else sums.where(keep)
    return salted_join(rows, side.drop("__n"), keys, heavy, how, salts)
