"""The property graph as DataFrames, and graph projections.

A graph is one DataFrame per node label (``guid`` + properties) and one per
edge type (``start_guid``, ``end_guid`` + properties). Added labels such as
FlaggedUser are derived DataFrames or boolean columns, never mutations.
A projection is a lazily evaluated edge DataFrame ``(rel, src, dst, w)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.sources.schema import IDENTIFIER_TYPES

NATURAL, REVERSE, UNDIRECTED = "NATURAL", "REVERSE", "UNDIRECTED"


@dataclass
class Graph:
    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]
    # Optional single-scan union of the identifier edges with columns
    # (start_guid, end_guid, rel, end_label). When absent it is a union.
    id_edges: DataFrame | None = None
    meta: dict = field(default_factory=dict)

    @property
    def users(self) -> DataFrame:
        return self.nodes["User"]

    def identifier_edges(self, types=("HAS_CC", "HAS_IP", "USED")) -> DataFrame:
        """User -> identifier edges of the given types, as
        ``(start_guid, end_guid, rel, end_label)``; parallel edges kept."""
        types = tuple(types)
        if self.id_edges is not None:
            df = self.id_edges
            if set(types) != set(IDENTIFIER_TYPES):
                df = df.where(F.col("rel").isin(*types))
            return df
        parts = [self.edges[t].select("start_guid", "end_guid",
                                      F.lit(t).alias("rel"),
                                      F.lit(IDENTIFIER_TYPES[t]).alias("end_label"))
                 for t in types]
        return reduce(DataFrame.unionByName, parts)

    def identifiers(self, labels=("Card", "Device", "IP")) -> DataFrame:
        """All identifier nodes as ``(label, guid)``."""
        parts = [self.nodes[lbl].select(F.lit(lbl).alias("label"), "guid") for lbl in labels]
        return reduce(DataFrame.unionByName, parts)


def orient(edges: DataFrame, orientation: str, weight: str | None = None) -> DataFrame:
    """Edges ``(start_guid, end_guid[, weight])`` -> ``(src, dst, w)``.

    NATURAL keeps direction, REVERSE swaps it, UNDIRECTED emits both
    directions (a self-loop once). ``w`` is the weight column or 1.0.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    types = dict(edges.dtypes)
    if orientation == UNDIRECTED and types["start_guid"] != types["end_guid"]:
        # Mixed key types (user -> identifier): one string key space.
        edges = edges.withColumn("start_guid", F.col("start_guid").cast("string")) \
                     .withColumn("end_guid", F.col("end_guid").cast("string"))
    nat = edges.select(F.col("start_guid").alias("src"), F.col("end_guid").alias("dst"), w.alias("w"))
    if orientation == NATURAL:
        return nat
    rev = edges.select(F.col("end_guid").alias("src"), F.col("start_guid").alias("dst"), w.alias("w"))
    if orientation == REVERSE:
        return rev
    if orientation == UNDIRECTED:
        return nat.unionByName(rev.where(F.col("src") != F.col("dst")))
    raise ValueError(f"unknown orientation {orientation}")


def aggregate_parallel(edges: DataFrame, aggregation: str | None) -> DataFrame:
    """Parallel-edge handling of a projection on ``(src, dst, w)``:
    None keeps every edge, SINGLE keeps one (weight of the max), SUM adds
    weights. Aggregates are partial (map-side) so hub pairs do not skew."""
    if aggregation in (None, "NONE"):
        return edges
    if aggregation == "SINGLE":
        return edges.groupBy("src", "dst").agg(F.max("w").alias("w"))
    if aggregation == "SUM":
        return edges.groupBy("src", "dst").agg(F.sum("w").alias("w"))
    raise ValueError(f"unknown aggregation {aggregation}")


def project(edges_by_type: dict[str, DataFrame], rels: dict[str, dict],
            src_nodes: DataFrame | None = None, dst_nodes: DataFrame | None = None) -> DataFrame:
    """Projection of several relationship types into one edge frame.

    ``rels`` maps an alias to ``{"type", "orientation", "aggregation",
    "weight"}``. Optional ``src_nodes``/``dst_nodes`` (``guid``) restrict the
    endpoints to node-label subsets: edges leaving the subset vanish. These
    are semi-joins, so the subsets are never collected.
    Output: ``(rel, src, dst, w)``.
    """
    parts = []
    for alias, spec in rels.items():
        e = edges_by_type[spec.get("type", alias)]
        if src_nodes is not None or dst_nodes is not None:
            e = restrict_endpoints(e, src_nodes, dst_nodes, spec.get("orientation", NATURAL))
        o = orient(e, spec.get("orientation", NATURAL), spec.get("weight"))
        o = aggregate_parallel(o, spec.get("aggregation"))
        parts.append(o.select(F.lit(alias).alias("rel"), "src", "dst", "w"))
    return reduce(DataFrame.unionByName, parts)


def restrict_endpoints(edges: DataFrame, src_nodes: DataFrame | None,
                       dst_nodes: DataFrame | None, orientation: str = NATURAL) -> DataFrame:
    """Keep edges whose start is in ``src_nodes`` and end in ``dst_nodes``
    (both optional ``guid`` frames), as ``left_semi`` joins."""
    if src_nodes is not None:
        edges = edges.join(src_nodes.select(F.col("guid").alias("start_guid")).distinct(),
                           "start_guid", "left_semi")
    if dst_nodes is not None:
        edges = edges.join(dst_nodes.select(F.col("guid").alias("end_guid")).distinct(),
                           "end_guid", "left_semi")
    return edges


def projection_counts(name: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node and relationship counts of a projection as one row."""
    both = (nodes.select(F.lit(1).alias("is_node"))
            .unionByName(edges.select(F.lit(0).alias("is_node"))))
    return both.agg(
        F.lit(name).alias("projection"),
        F.count_if(F.col("is_node") == 1).alias("nodeCount"),
        F.count_if(F.col("is_node") == 0).alias("relationshipCount"),
    )
