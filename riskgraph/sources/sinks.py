"""Graph sinks as DataFrame operations: node upsert, edge attach, merges,
endpoint labels and keyed write-back. Nothing is mutated in place; every
function returns the new table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_nodes(existing: DataFrame, incoming: DataFrame, key: str = "guid") -> DataFrame:
    """Create-or-update nodes by key (one full outer join).

    For a key present in ``incoming`` every incoming column takes the
    incoming value (a null overwrites); columns only in ``existing`` keep the
    old value. Other keys keep their old row.
    """
    inc_cols = [c for c in incoming.columns if c != key]
    old_cols = [c for c in existing.columns if c != key]
    e = existing.select(key, *[F.col(c).alias(f"__old_{c}") for c in old_cols])
    i = incoming.select(key, F.lit(True).alias("__inc"), *[F.col(c).alias(f"__new_{c}") for c in inc_cols])
    j = e.join(i, key, "full_outer")
    out = [F.col(key)]
    for c in old_cols + [c for c in inc_cols if c not in old_cols]:
        if c in inc_cols and c in old_cols:
            v = F.when(F.col("__inc"), F.col(f"__new_{c}")).otherwise(F.col(f"__old_{c}"))
        elif c in inc_cols:
            v = F.col(f"__new_{c}")
        else:
            v = F.col(f"__old_{c}")
        out.append(v.alias(c))
    return j.select(*out)


def key_violations(nodes: DataFrame, key: str = "guid") -> DataFrame:
    """Keys that occur more than once: ``(key, cnt)``. Partial aggregation
    keeps a hot key from landing on one task as raw rows."""
    return (nodes.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1))


def last_row_per_key(df: DataFrame, key, order_cols: list[str]) -> DataFrame:
    """The last row per key in ``order_cols`` order (later wins, every column
    of that row taken, nulls included). ``max_by`` on a struct is a partial
    aggregate: a key holding a third of the rows still combines map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("__r"))
    return picked.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def merge_nodes(existing: DataFrame, incoming: DataFrame, order_cols: list[str], key: str = "guid",
                helpers: tuple[str, ...] = ()) -> DataFrame:
    """Node MERGE of a batch: per key the last incoming row wins (a null
    removes the property), then create-or-update into ``existing``. Order columns
    are properties like any other; ``helpers`` are left out."""
    last = last_row_per_key(incoming, key, order_cols).drop(*helpers)
    return upsert_nodes(existing, last, key)


def attach_edges(edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
                 props: list[str] | None = None) -> DataFrame:
    """Edge append with endpoint matching: an edge is kept only when both
    endpoints exist (two ``left_semi`` joins, key ``guid``); every matching
    input row becomes an edge (parallel edges kept). ``props`` limits the
    carried properties."""
    e = edges
    if props is not None:
        e = e.select("start_guid", "end_guid", *props)
    e = e.join(src_nodes.select(F.col("guid").alias("start_guid")), "start_guid", "left_semi")
    e = e.join(dst_nodes.select(F.col("guid").alias("end_guid")), "end_guid", "left_semi")
    return e.select("start_guid", "end_guid", *[c for c in e.columns if c not in ("start_guid", "end_guid")])


def merge_edges(edges: DataFrame, src_nodes: DataFrame, dst_nodes: DataFrame,
                order_cols: list[str]) -> DataFrame:
    """Edge MERGE: endpoints matched, parallel edges collapsed to one per
    (start, end), the last row in ``order_cols`` order giving properties."""
    attached = attach_edges(edges, src_nodes, dst_nodes)
    return last_row_per_key(attached, ["start_guid", "end_guid"], order_cols)


def endpoint_labels(edges: DataFrame) -> DataFrame:
    """Distinct (start_label, end_label) pairs of an edge table. The loader
    requires exactly one; callers assert it on this tiny result."""
    return edges.select("start_label", "end_label").distinct()


def write_back(users: DataFrame, scores: DataFrame, column: str, key: str = "guid") -> DataFrame:
    """Write one computed column into ``users`` by key (one left join).
    Keys without a score keep any previous value of the column."""
    s = scores.select(key, F.col(column).alias("__v"))
    j = users.join(s, key, "left")
    if column in users.columns:
        return j.withColumn(column, F.coalesce(F.col("__v"), F.col(column))).drop("__v")
    return j.withColumnRenamed("__v", column)



def unwind_batches(df: DataFrame, column: str = "batches") -> DataFrame:
    """Rows carried as a list of records (``array<struct>``) -> one row per
    record, its fields as columns (``explode``; runs per partition)."""
    return df.select(F.explode(F.col(column)).alias("__r")).select("__r.*")
