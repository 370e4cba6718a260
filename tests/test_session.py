from pyspark.sql import functions as F

from riskgraph.session import cut_lineage, cut_lineage_observed, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = ensure_checkpoint_dir(spark)
    assert configured and d.replace("file:", "").startswith(configured.replace("file:", "").rstrip("/"))


def test_cut_lineage_writes_a_table_under_the_checkpoint_dir(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    out = cut_lineage(df)
    assert sorted(r.x for r in out.collect()) == list(range(0, 20, 2))
    files = out.inputFiles()
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
    out2, m = cut_lineage_observed(df, bucket_by=["id"], buckets=3, n=F.count(F.lit(1)), s=F.sum("x"))
    assert m == {"n": 10, "s": 90} and out2.count() == 10
