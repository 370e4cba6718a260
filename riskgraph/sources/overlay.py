"""The test-data graph: a payment graph derived from the TPC-H-like tables.

The driver's tables carry no graph, so one is derived by SQL-equivalent
DataFrame code that the DuckDB oracle repeats verbatim (see FIXTURES.md):
customers are users, returned/accepted/open line items of an order become
card, device and IP edges of the ordering customer, and pending orders are
transfers to one of the next four customers.

Fixed values (must match the oracle's SQL): flag rule ``custkey % 53 = 7``;
cards: returnflag 'R', id ``C<custkey div 3>-<partkey % 4>``;
devices: returnflag 'A', id ``D<custkey div 5>-<suppkey % 6>`` or the
hub ``DH<custkey div 50>`` when ``suppkey % 6 = 5``; IPs: returnflag 'N',
id ``I<suppkey>`` (every line item is one edge); transfers: status 'P' (a
pending order is what a transfer means here), receiver
``custkey + 1 + orderkey % 4``; referrals: ``custkey % 3 = 0``, ``custkey > 0``,
referrer ``custkey div 2``.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.operators.graph import Graph
from riskgraph.session import cut_lineage
from riskgraph.sources.sinks import attach_edges, last_row_per_key, merge_edges


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{table}.parquet"))


def overlay_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("guid"),
        F.when(F.col("c_custkey") % 53 == 7, 1).otherwise(0).alias("fraudMoneyTransfer"),
        F.col("c_acctbal").alias("moneyTransferErrorCancelAmount"),
    )


def _div(c, n):
    return F.floor(F.col(c) / n).cast("bigint").cast("string")


def overlay_identifier_edges(spark: SparkSession, sf_dir: str, types=("HAS_CC", "USED", "HAS_IP")) -> DataFrame:
    """All user->identifier edges of the requested types from ONE scan of
    lineitem joined once to orders: ``(start_guid, end_guid, rel, end_label,
    edgeDate)``. The scan reads five lineitem columns with the flag
    predicate pushed into Parquet."""
    return identifier_edges_from(_read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "orders"), types)


def identifier_edges_from(lineitem: DataFrame, orders: DataFrame,
                          types=("HAS_CC", "USED", "HAS_IP")) -> DataFrame:
    """The identifier-edge derivation over given line items (a batch or a
    stream) and orders (batch)."""
    flags = {"HAS_CC": "R", "USED": "A", "HAS_IP": "N"}
    wanted = [flags[t] for t in types]
    li = (lineitem
          .where(F.col("l_returnflag").isin(*wanted))
          .select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"))
    o = orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    flag = F.col("l_returnflag")
    rel = (F.when(flag == "R", F.lit("HAS_CC"))
           .when(flag == "A", F.lit("USED"))
           .otherwise(F.lit("HAS_IP")))
    end_label = (F.when(flag == "R", F.lit("Card"))
                 .when(flag == "A", F.lit("Device"))
                 .otherwise(F.lit("IP")))
    card = F.concat(F.lit("C"), _div("o_custkey", 3), F.lit("-"), (F.col("l_partkey") % 4).cast("string"))
    device = F.when(F.col("l_suppkey") % 6 == 5,
                    F.concat(F.lit("DH"), _div("o_custkey", 50))) \
        .otherwise(F.concat(F.lit("D"), _div("o_custkey", 5), F.lit("-"), (F.col("l_suppkey") % 6).cast("string")))
    ip = F.concat(F.lit("I"), F.col("l_suppkey").cast("string"))
    end_guid = F.when(flag == "R", card).when(flag == "A", device).otherwise(ip)
    return j.select(
        F.col("o_custkey").alias("start_guid"),
        end_guid.alias("end_guid"),
        rel.alias("rel"),
        end_label.alias("end_label"),
        F.col("l_shipdate").alias("edgeDate"),
    )


def overlay_p2p(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transfers, before endpoint matching (some receivers do not exist)."""
    return transfers_from(_read(spark, sf_dir, "orders"))


def transfers_from(orders: DataFrame) -> DataFrame:
    """The transfer derivation over given orders (a batch or a stream)."""
    o = orders.where(F.col("o_orderstatus") == "P")
    return o.select(
        F.col("o_custkey").alias("start_guid"),
        (F.col("o_custkey") + 1 + F.col("o_orderkey") % 4).alias("end_guid"),
        F.col("o_totalprice").alias("totalAmount"),
        F.col("o_orderdate").alias("transactionDateTime"),
        F.col("o_orderkey").alias("_order"),
    )


def overlay_referred(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").where((F.col("c_custkey") % 3 == 0) & (F.col("c_custkey") > 0))
    return c.select(F.col("c_custkey").alias("start_guid"),
                    F.floor(F.col("c_custkey") / 2).cast("bigint").alias("end_guid"))


_DATE_COL = {"HAS_CC": "cardDate", "USED": "deviceDate", "HAS_IP": "ipDate"}
_LABEL = {"HAS_CC": "Card", "USED": "Device", "HAS_IP": "IP"}


def overlay_graph(spark: SparkSession, sf_dir: str, parallel_edges: str = "keep",
                  materialize: bool = False) -> Graph:
    """Build the graph: nodes first, then edges attached to existing nodes
    (edges with a missing endpoint are dropped). ``parallel_edges="keep"``
    appends every row; ``"merge"`` keeps one edge per (start, end), the last
    by date (then amount, then source order).

    With ``materialize`` the graph is loaded once: users, identifier edges
    and transfers are written as tables in the checkpoint folder, so later
    queries read the compact edge tables instead of re-deriving them. They
    are deliberately not bucketed on the user key: a user holding a third
    of the edges would make one bucket (one task) that AQE cannot split,
    while a shuffle join lets AQE split the hot key.
    """
    users = overlay_users(spark, sf_dir)
    id_edges = overlay_identifier_edges(spark, sf_dir)
    if parallel_edges == "merge":
        # the date is the only property, so rows tied on it are identical
        id_edges = last_row_per_key(id_edges, ["start_guid", "end_guid", "rel"], ["edgeDate"])
    elif parallel_edges != "keep":
        raise ValueError("parallel_edges must be 'keep' or 'merge'")
    if materialize:
        users = cut_lineage(users)
        id_edges = cut_lineage(id_edges)
    edges: dict[str, DataFrame] = {}
    nodes: dict[str, DataFrame] = {"User": users}
    for t in ("HAS_CC", "USED", "HAS_IP"):
        e = id_edges.where(F.col("rel") == t).select(
            "start_guid", "end_guid", F.col("edgeDate").alias(_DATE_COL[t]))
        edges[t] = e
        nodes[_LABEL[t]] = e.select(F.col("end_guid").alias("guid")).distinct()
    p2p = overlay_p2p(spark, sf_dir)
    if parallel_edges == "merge":
        edges["P2P"] = merge_edges(p2p, users, users, ["transactionDateTime", "totalAmount", "_order"]).drop("_order")
    else:
        edges["P2P"] = attach_edges(p2p, users, users).drop("_order")
    if materialize:
        edges["P2P"] = cut_lineage(edges["P2P"])
    edges["REFERRED"] = attach_edges(overlay_referred(spark, sf_dir), users, users)
    if parallel_edges == "merge":
        edges["REFERRED"] = edges["REFERRED"].distinct()
    return Graph(nodes=nodes, edges=edges,
                 id_edges=id_edges.select("start_guid", "end_guid", "rel", "end_label"),
                 meta={"sf_dir": sf_dir, "parallel_edges": parallel_edges,
                       "nodes_of_edges": tuple(_LABEL.values())})


def overlay_tables(spark: SparkSession, sf_dir: str, g: Graph | None = None) -> dict[str, DataFrame]:
    """The nine source tables of the overlay in file form (with labels), of the
    graph ``g`` where it is built already."""
    g = g or overlay_graph(spark, sf_dir)
    out = {
        "cards": g.nodes["Card"], "device": g.nodes["Device"], "ip": g.nodes["IP"], "user": g.users,
    }
    names = {"HAS_CC": "has_cc", "USED": "used", "HAS_IP": "has_ip", "P2P": "p2p", "REFERRED": "referred"}
    starts = {"HAS_CC": "User", "USED": "User", "HAS_IP": "User", "P2P": "User", "REFERRED": "User"}
    ends = {"HAS_CC": "Card", "USED": "Device", "HAS_IP": "IP", "P2P": "User", "REFERRED": "User"}
    for t, e in g.edges.items():
        out[names[t]] = e.withColumn("start_label", F.lit(starts[t])).withColumn("end_label", F.lit(ends[t]))
    return out
