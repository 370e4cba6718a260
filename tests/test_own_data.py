"""A user of the reference switches with their own files: the nine tables
as Parquet, loaded with ``load_graph`` and analysed by the same pipeline."""

from pyspark.sql import functions as F

from riskgraph.plans import reports
from riskgraph.plans.pipeline import FraudPipeline
from riskgraph.sources.files import write_table
from riskgraph.sources.loader import load_graph
from riskgraph.sources.overlay import overlay_tables
from tests.conftest import SF_SMALL


def test_pipeline_on_loaded_parquet_graph(spark, tmpdir_path):
    tables = overlay_tables(spark, SF_SMALL)
    # string guids as in real data
    for name, df in tables.items():
        for c in ("guid", "start_guid", "end_guid"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c).cast("string"))
        write_table(df, tmpdir_path, name)
    g = load_graph(spark, tmpdir_path)
    mine = FraudPipeline(spark, g)
    ref = FraudPipeline.for_testdata(spark, SF_SMALL)
    a = {r.componentSize: (r.numberOfComponents, r.fraudUserCount) for r in reports.wcc_size_stats(mine).collect()}
    b = {r.componentSize: (r.numberOfComponents, r.fraudUserCount) for r in reports.wcc_size_stats(ref).collect()}
    assert a == b
    assert mine.similarity.count() == ref.similarity.count() == 1248
    assert reports.p2p_flagged_share(mine).first().p == reports.p2p_flagged_share(ref).first().p
    top = reports.weighted_degree_top(mine).collect()
    assert len(top) == 7 and all(len(r.uid) <= 8 for r in top)   # left(guid, 8) of string ids
