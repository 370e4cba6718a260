"""Disk: tables that were written on the way, and shuffle files, go once the result is written."""

import os
import time

from pyspark.sql import functions as F

from riskgraph.plans.pipeline import FraudPipeline
from riskgraph.session import cut_lineage, ensure_checkpoint_dir, kept, written


def tables(spark) -> set[str]:
    folder = ensure_checkpoint_dir(spark).replace("file:", "") + "/tables"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_similarity_leaves_its_result_alone(spark):
    edges = [(n, f"D{n // 3}", "Device", n // 3, 1, 3, 3) for n in range(30)] + \
        [(n, f"I{n % 2}", "IP", 100 + n % 2, 1, 15, 15) for n in range(30)]
    p = FraudPipeline(spark, None)
    p.__dict__["risk_edges"] = cut_lineage(spark.createDataFrame(
        edges, "start_guid long, end_guid string, end_label string, end_id long, fraudRisk int, degree long, fraudRiskDegree long"))
    before = tables(spark)
    found = p.similarity
    assert len(tables(spark) - before) == 1 and before <= tables(spark)
    assert found.count() == 300 and p.risk_edges.count() == 60      # ten each; what it reads is still there


def test_only_tables_of_the_way_go(spark):
    early = cut_lineage(spark.range(3))
    shared = []

    def inner():
        return cut_lineage(spark.range(4)).unionByName(early)

    def build():
        if not shared:
            shared.append(kept(spark, inner))           # asked for by others later
        way = written(spark, inner)
        both = cut_lineage(way.unionByName(shared[0]))
        return both, both.where("id = 3")
    before = tables(spark)
    both, three = written(spark, build)
    assert (early.count(), shared[0].count(), both.count(), three.count()) == (3, 7, 14, 2)
    assert len(tables(spark) - before) == 3


def test_shuffle_files_of_a_write_go_with_it(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        files = disk.getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.endswith(".data")}
    before = shuffled()
    out = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert out.count() == 7
