"""The corpus pipeline: toxicity, near duplicates, mixing and packing, each
stage on all that the one before it kept. Each stage's result is written as
Parquet and read again, so a lost executor costs no earlier stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm import minhash_bottomk, mixing, packing, toxicity_ws
from riskgraph.llm.common import importable
from riskgraph.session import scratch_dir


BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def _documents(docs: DataFrame) -> DataFrame:
    """The columns that the stages hand on. Executors hold what all stages have touched,
    so batches for Python are smaller here than in a single operator (16m)."""
    spark = docs.sparkSession
    importable(spark)
    if spark.conf.get(BATCH) == "16m":
        spark.conf.set(BATCH, BATCH_BYTES)
    return docs.select("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity_ws.drop_toxic(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, 0.8)."""
    return minhash_bottomk.drop_duplicates(_documents(docs), words=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, whole and in part, as their source's target asks."""
    return mixing.mix(_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows. Executors still hold what the stages before
    have touched, so the caches of words are small here and go with their task."""
    return packing.pack(_documents(docs), cache_bytes=16 << 20, keep_encoder=False)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("pack", pack)]
#: The stages hash, tokenize and learn; SQL can't express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline/{uuid.uuid4().hex}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
