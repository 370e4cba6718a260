"""File sources and sinks: headerless CSV in, Parquet out, discovery, export."""

from __future__ import annotations

import posixpath
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.sources.schema import (
    CSV_COLUMNS,
    canonical_table,
    classify,
    table_schema,
)


class UnknownTableError(ValueError):
    """A CSV file whose base name is not one of the known tables."""


def table_of(path: str) -> str:
    """Table name of a file: the base name with every suffix removed.

    ``user.csv`` and ``user.csv.gz`` both give ``user``. An unknown name is
    an error here (conversion must not silently drop a file).
    """
    base = posixpath.basename(path.rstrip("/"))
    name = base.split(".", 1)[0] if not base.startswith(".") else base
    if canonical_table(name) not in CSV_COLUMNS:
        raise UnknownTableError(f"no known schema for '{name}'")
    return canonical_table(name)


def read_table_csv(spark: SparkSession, path: str, table: str | None = None,
                   infer_types: bool = False) -> DataFrame:
    """Read a headerless CSV (gzip is decoded by the reader) with the fixed
    column list of its table. Types come from the table schema, or from
    inference when ``infer_types`` is set (then only the names are fixed)."""
    table = canonical_table(table or table_of(path))
    reader = spark.read.option("header", "false")
    if infer_types:
        df = reader.option("inferSchema", "true").csv(path)
        return df.toDF(*CSV_COLUMNS[table])
    return reader.schema(table_schema(table)).csv(path)


def write_table(df: DataFrame, out_dir: str, table: str, mode: str = "overwrite") -> str:
    """Write one table as snappy Parquet at ``out_dir/<table>.parquet``."""
    path = posixpath.join(out_dir, f"{canonical_table(table)}.parquet")
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def convert_csv_dir(spark: SparkSession, in_dir: str, out_dir: str) -> dict[str, str]:
    """CSV folder -> one Parquet table per known file name; unknown names raise."""
    files = list_files(spark, in_dir, "*.csv*")
    by_table: dict[str, list[str]] = {}
    for f in files:
        by_table.setdefault(table_of(f), []).append(f)
    written = {}
    for table, paths in sorted(by_table.items()):
        df = read_table_csv(spark, paths, table) if len(paths) > 1 else read_table_csv(spark, paths[0], table)
        written[table] = write_table(df, out_dir, table)
    return written


def list_files(spark: SparkSession, directory: str, glob: str) -> list[str]:
    """Paths under ``directory`` matching ``glob``, listed by Spark's file
    index (works on any Hadoop file system). Only paths reach the driver."""
    listing = (spark.read.format("binaryFile")
               .option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true")
               .load(directory)
               .select("path"))
    return sorted(r.path for r in listing.collect())


def list_tables(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the Parquet tables under ``directory``: the outermost folder
    (or file) named ``*.parquet``, also of partitioned tables. Part files are
    folded into their table on the executors."""
    inside = F.regexp_extract("path", r"^(.*?[^/]\.parquet)(/.*)?$", 1)
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
               .load(directory).select(inside.alias("path")).distinct())
    return sorted(r.path for r in listing.collect())


def discover(spark: SparkSession, directory: str) -> dict[str, list[tuple[str, str]]]:
    """Find Parquet tables in ``directory`` and classify each by base name.

    Returns ``{"nodes": [(table, path)], "edges": [...], "unknown": [...]}``.
    Unknown names are reported and skipped, not an error. A Spark-written
    table is a folder ``<table>.parquet/part-*.parquet``: its folder names it.
    """
    found: dict[str, str] = {}
    for p in list_tables(spark, directory):
        table_path = p
        name = posixpath.basename(table_path)[: -len(".parquet")]
        if found.setdefault(name, table_path) != table_path:
            raise ValueError(f"two tables are named {name}: {found[name]} and {table_path}")
    out: dict[str, list[tuple[str, str]]] = {"nodes": [], "edges": [], "unknown": []}
    for name, path in sorted(found.items()):
        kind = classify(name)
        key = {"node": "nodes", "edge": "edges"}.get(kind, "unknown")
        out[key].append((canonical_table(name) if kind != "unknown" else name, path))
        if kind == "unknown":
            print(f"unknown file: {path}")
    return out


def normalise_timestamps(df: DataFrame, columns=("transactionDateTime",)) -> DataFrame:
    """Cast the named columns to the session-zone timestamp type."""
    for c in columns:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write any result as headerless CSV (one folder of part files)."""
    df.write.mode(mode).option("header", "false").csv(path)
    return path


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (tableName, rowCount), one union + groupBy."""
    parts = [df.select(F.lit(name).alias("tableName")) for name, df in tables.items()]
    unioned = reduce(DataFrame.unionByName, parts)
    return unioned.groupBy("tableName").agg(F.count(F.lit(1)).alias("rowCount"))


def load_totals(tables: dict[str, DataFrame], kinds: dict[str, str]) -> DataFrame:
    """Load totals per table, per kind (node/edge) and overall via rollup.

    Rows: (kind, tableName, rowCount); null keys on the subtotal lines.
    """
    parts = [df.select(F.lit(kinds[name]).alias("kind"), F.lit(name).alias("tableName"))
             for name, df in tables.items()]
    unioned = reduce(DataFrame.unionByName, parts)
    return unioned.rollup("kind", "tableName").agg(F.count(F.lit(1)).alias("rowCount"))

