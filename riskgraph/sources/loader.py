"""Parquet folder -> Graph: discover the node and edge tables, read the
nodes first, then attach every edge table to them (edges whose endpoint
is missing are dropped), optionally collapsing parallel edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.operators.graph import Graph
from riskgraph.sources.files import discover, normalise_timestamps
from riskgraph.sources.schema import EDGE_TABLES, NODE_TABLES
from riskgraph.sources.sinks import attach_edges, key_violations, merge_edges


def load_graph(spark: SparkSession, directory: str, parallel_edges: str = "keep",
               check_keys: bool = False) -> Graph:
    """Build the graph from ``<table>.parquet`` files in ``directory``.

    ``parallel_edges``: ``"keep"`` appends every edge row (bulk-load
    semantics); ``"merge"`` keeps one edge per (start, end) with the
    properties of the last row by the edge's date column (MERGE
    semantics). With ``check_keys`` a duplicate node key raises (one
    aggregate per node table; only the violation count reaches the driver).
    """
    found = discover(spark, directory)
    nodes: dict[str, DataFrame] = {}
    for table, path in found["nodes"]:
        df = spark.read.parquet(path)
        if check_keys:
            n = key_violations(df.select("guid")).agg(F.count(F.lit(1)).alias("n")).first()["n"]
            if n:
                raise ValueError(f"{n} duplicate guid values in {table}")
        nodes[NODE_TABLES[table]] = df
    edges: dict[str, DataFrame] = {}
    for table, path in found["edges"]:
        etype, start_label, end_label, props = EDGE_TABLES[table]
        if start_label not in nodes or end_label not in nodes:
            raise ValueError(f"{table}: no node table for {start_label} or {end_label} in the folder")
        raw = normalise_timestamps(spark.read.parquet(path))
        raw = raw.select("start_guid", "end_guid", *[p for p in props if p in raw.columns])
        if parallel_edges == "merge":
            order = [p for p in props if p in raw.columns] or ["start_guid"]
            # a date (then the amount) decides which parallel row is last
            order = sorted(order, key=lambda c: 0 if ("Date" in c or "Time" in c) else 1)
            edges[etype] = merge_edges(raw, nodes[start_label], nodes[end_label], order)
        elif parallel_edges == "keep":
            edges[etype] = attach_edges(raw, nodes[start_label], nodes[end_label])
        else:
            raise ValueError("parallel_edges must be 'keep' or 'merge'")
    return Graph(nodes=nodes, edges=edges, meta={"dir": directory, "parallel_edges": parallel_edges})
