"""A global dictionary of nodes: (label, guid) -> dense long id.

Node keys are unique within a label only, and keys of different labels may be
equal (a card and a device with the same id). Operators that mix labels join on
the id. The ids are the ranks of (label, guid) (see ``ranges.py``), the same for the
same keys under any partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.graph import Graph
from riskgraph.operators.joinback import heavy_keys, salted_join
from riskgraph.operators.ranges import numbered
from riskgraph.session import cut_lineage

def dense_ids(keys: DataFrame, cols: list[str], out: str = "id") -> DataFrame:
    """The distinct rows of ``keys[cols]`` with their rank, from 0, as ``out``."""
    return numbered(keys.select(*cols).distinct(), cols, out)


def edge_ends(id_edges: DataFrame) -> DataFrame:
    """``(end_label, end_key, __n)``: the identifiers that edges name, keys as
    strings, with the number of their edges. Written once, for the dictionary and
    for the joins with it."""
    return cut_lineage(id_edges.groupBy("end_label", F.col("end_guid").cast("string").alias("end_key"))
                       .agg(F.count(F.lit(1)).alias("__n")))


def node_dictionary(g: Graph, ends: DataFrame | None = None) -> DataFrame:
    """``(label, guid, id)`` of every node, and of every identifier that an edge
    names (``ends``, see ``edge_ends``); guids as strings. Labels whose nodes were
    derived from the edges (``meta["nodes_of_edges"]``) are read from these alone."""
    ends = edge_ends(g.identifier_edges()) if ends is None else ends
    known = g.meta.get("nodes_of_edges", ())
    parts = [n.select(F.lit(label).alias("label"), F.col("guid").cast("string").alias("guid"))
             for label, n in g.nodes.items() if label not in known]
    parts.append(ends.select(F.col("end_label").alias("label"), F.col("end_key").alias("guid")))
    return dense_ids(reduce(DataFrame.unionByName, parts), ["label", "guid"])


def with_end_ids(id_edges: DataFrame, dictionary: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Identifier edges with the id of their identifier as ``end_id``; the edges
    of hub identifiers are spread by a salt. All other edges are looked up in
    partitions of the dictionary (a hash join), so they are not sorted."""
    ends = edge_ends(id_edges) if ends is None else ends
    e = id_edges.withColumn("end_key", F.col("end_guid").cast("string"))
    d = dictionary.select(F.col("label").alias("end_label"), F.col("guid").alias("end_key"), F.col("id").alias("end_id"))
    return salted_join(e, d.hint("shuffle_hash"), ["end_label", "end_key"], heavy_keys(ends, ["end_label", "end_key"])) \
        .select(*id_edges.columns, "end_id")


def user_ids(dictionary: DataFrame, guid: str, out: str) -> DataFrame:
    """The users' part of the dictionary, ready to be joined on a user column."""
    return dictionary.where(F.col("label") == "User").select(F.col("guid").alias(guid), F.col("id").alias(out))
