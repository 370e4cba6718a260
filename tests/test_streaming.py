import os

from riskgraph.streaming.ingest import merged_view, node_merge_stream


def test_node_stream_later_epoch_wins(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    log = os.path.join(tmpdir_path, "log")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    schema = "guid long, fraudMoneyTransfer int, seq int"
    spark.createDataFrame([(1, 0, 1), (2, 1, 1), (1, 1, 0)], schema).coalesce(1).write.parquet(src + "/b1")
    q = node_merge_stream(spark, src + "/*", schema, log, ckpt)
    q.awaitTermination()
    first = {r.guid: r.fraudMoneyTransfer for r in merged_view(spark, log, "guid", ["seq"]).collect()}
    assert first == {1: 0, 2: 1}          # within an epoch the larger seq wins
    spark.createDataFrame([(1, 1, 0), (3, 0, 0)], schema).coalesce(1).write.parquet(src + "/b2")
    q = node_merge_stream(spark, src + "/*", schema, log, ckpt)   # same checkpoint: only the new file
    q.awaitTermination()
    second = {r.guid: r.fraudMoneyTransfer for r in merged_view(spark, log, "guid", ["seq"]).collect()}
    assert second == {1: 1, 2: 1, 3: 0}   # a later epoch wins over a larger seq
