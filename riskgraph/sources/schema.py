"""Table schemas of the node and edge files and the graph mapping.

Fixed values (must equal the source format): the column lists of the nine
headerless CSV tables, in file order, and the node label / edge type each
table maps to with its kept edge properties.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampType()

# Column names per table, in CSV column order.
CSV_COLUMNS = {
    "cards": ["guid", "cardType", "level"],
    "device": ["guid", "device", "os"],
    "ip": ["guid"],
    "user": ["guid", "fraudMoneyTransfer", "moneyTransferErrorCancelAcmount"],
    "has_ip": ["start_guid", "start_label", "end_guid", "end_label", "ipDate"],
    "has_cc": ["start_guid", "start_label", "end_guid", "end_label", "cardDate"],
    "p2p": ["start_guid", "start_label", "end_guid", "end_label", "totalAmount", "transactionDateTime"],
    "referred": ["start_guid", "start_label", "end_guid", "end_label"],
    "used": ["start_guid", "start_label", "end_guid", "end_label", "deviceDate"],
}

_TYPES = {
    "fraudMoneyTransfer": T.IntegerType(),
    "moneyTransferErrorCancelAcmount": T.DoubleType(),
    "totalAmount": T.DoubleType(),
    "transactionDateTime": TS,
    "ipDate": TS,
    "cardDate": TS,
    "deviceDate": TS,
}


def table_schema(table: str) -> T.StructType:
    """Explicit StructType of a known table (strings unless typed above)."""
    cols = CSV_COLUMNS[canonical_table(table)]
    return T.StructType([T.StructField(c, _TYPES.get(c, S), True) for c in cols])


# Node tables -> label; edge tables -> (type, start label,
# end label, kept properties). "card" is accepted as a name for "cards".
NODE_TABLES = {"cards": "Card", "device": "Device", "ip": "IP", "user": "User"}
EDGE_TABLES = {
    "has_cc": ("HAS_CC", "User", "Card", ["cardDate"]),
    "has_ip": ("HAS_IP", "User", "IP", ["ipDate"]),
    "p2p": ("P2P", "User", "User", ["totalAmount", "transactionDateTime"]),
    "referred": ("REFERRED", "User", "User", []),
    "used": ("USED", "User", "Device", ["deviceDate"]),
}
TABLE_ALIASES = {"card": "cards"}

IDENTIFIER_TYPES = {"HAS_CC": "Card", "HAS_IP": "IP", "USED": "Device"}


def canonical_table(name: str) -> str:
    return TABLE_ALIASES.get(name, name)


def classify(table: str) -> str:
    """'node', 'edge' or 'unknown' for a table base name."""
    t = canonical_table(table)
    if t in NODE_TABLES:
        return "node"
    if t in EDGE_TABLES:
        return "edge"
    return "unknown"
