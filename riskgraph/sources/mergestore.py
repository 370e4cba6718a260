"""A table that is merged from batches (MERGE: create or update by key).

Each batch is an *epoch*: its last row a key, by the order columns, is written as a
delta, partitioned by a bucket of the key. A manifest row names the epoch, its
columns and its folder; an epoch counts once its manifest row is there, and writing
an epoch again (after a failure, or a replay) replaces delta and row, so that
nothing is counted twice. Reading merges the deltas bucket by bucket into the last
compacted base: for every property the value of the last row that carries the
property, by the order columns, then the epoch. A null removes the property (it is
a value like any other); a property that a batch does not have is left as it is;
order columns are properties too. Compaction writes the merged table as the next
base, with the order and epoch of every property's value, so that a row that comes
late but is older still loses.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.sources.sinks import last_row_per_key

EPOCH, BUCKET, AT = "_epoch", "_bucket", "_at"


class MergeStore:
    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), list(key), list(order), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _entries(self) -> list:
        """Manifest rows, oldest first: one an epoch and base."""
        try:
            rows = self.spark.read.parquet(posixpath.join(self.path, "manifest")).collect()
        except Exception as e:  # noqa: BLE001 - nothing has been written yet
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
                return []
            raise
        return sorted(rows, key=lambda r: (r["epoch"], r["kind"]))

    def _commit(self, kind: str, epoch: int, folder: str, columns: list[str]) -> None:
        row = self.spark.createDataFrame([(kind, epoch, folder, columns)],
                                         "kind string, epoch long, folder string, columns array<string>")
        row.coalesce(1).write.mode("overwrite").parquet(posixpath.join(self.path, "manifest", f"entry={kind}-{epoch}"))

    def _properties(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c not in (*self.key, EPOCH, BUCKET)]

    def write(self, batch: DataFrame, epoch: int) -> None:
        """Adds (or replaces) the delta of an epoch."""
        folder = posixpath.join(self.path, "delta", f"{EPOCH}={epoch}")
        last = last_row_per_key(batch, self.key, self.order)
        (last.withColumn(BUCKET, self._bucket()).repartition(self.buckets, BUCKET).write.mode("overwrite")
         .partitionBy(BUCKET).parquet(folder))
        self._commit("delta", epoch, folder, batch.columns)

    def _stamped(self, df: DataFrame, columns: list[str], epoch: int) -> DataFrame:
        """Every property as (order, epoch, value), in its place."""
        at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)], F.lit(epoch).cast("long").alias("epoch"))
        return df.select(*self.key, *[F.struct(at.alias("at"), F.col(c).alias("value")).alias(c)
                                      for c in self._properties(columns)])

    def _merged(self) -> tuple[DataFrame | None, int]:
        entries = self._entries()
        bases = [e for e in entries if e["kind"] == "base"]
        base = bases[-1] if bases else None
        parts = [] if base is None else [self.spark.read.parquet(base["folder"]).drop(BUCKET)]
        newest = base["epoch"] if base else -1
        for e in entries:
            if e["kind"] == "delta" and e["epoch"] > (base["epoch"] if base else -1):
                parts.append(self._stamped(self.spark.read.parquet(e["folder"]), e["columns"], e["epoch"]))
                newest = max(newest, e["epoch"])
        if not parts:
            return None, newest
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        # a property that a batch does not have is a null struct, which max_by passes over
        return rows.groupBy(*self.key).agg(*[F.max_by(c, F.col(f"{c}.at")).alias(c)
                                             for c in self._properties(rows.columns)]), newest

    def read(self) -> DataFrame:
        """The table as of the last epoch: keys and properties."""
        rows, _ = self._merged()
        if rows is None:
            raise ValueError(f"no epoch has been written to {self.path}")
        return rows.select(*self.key, *[F.col(f"{c}.value").alias(c) for c in self._properties(rows.columns)])

    def compact(self) -> None:
        """Writes the merged table as the next base; later reads start from it."""
        rows, epoch = self._merged()
        if rows is None:
            return
        folder = posixpath.join(self.path, "base", f"{EPOCH}={epoch}")
        (rows.withColumn(BUCKET, self._bucket()).repartition(self.buckets, BUCKET).write.mode("overwrite")
         .partitionBy(BUCKET).parquet(folder))
        self._commit("base", epoch, folder, rows.columns)
