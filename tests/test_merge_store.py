"""The merge store: epochs, replays, missing and null properties, compaction, and
the same batches by a stream."""

import os

from pyspark.sql import functions as F

from riskgraph.sources.mergestore import MergeStore

SCHEMA = "guid long, flag int, amount double, at int"
EPOCHS = [[(1, 0, 5.0, 10), (2, 1, 6.0, 10), (1, 1, 7.0, 12), (3, 0, 1.0, 9)],
          [(1, 0, None, 11), (2, 0, None, 20), (4, 1, 2.0, 1)],
          [(3, 1, 8.0, 3), (4, 0, 9.0, 1), (2, 1, 4.0, 15)]]


def rows(store):
    return sorted(tuple(r[c] for c in ("guid", "flag", "amount", "at")) for r in store.read().collect())


#: 1: the row of 12 stays; 2: the row of 20, whose amount is removed; 3: an older row loses; 4: the later epoch of one time
WANT = [(1, 1, 7.0, 12), (2, 0, None, 20), (3, 0, 1.0, 9), (4, 0, 9.0, 1)]


def test_batch_replay_compaction_and_stream_agree(spark, tmpdir_path):
    store = MergeStore(spark, tmpdir_path + "/a", ["guid"], ["at"], buckets=3)
    for i, e in enumerate(EPOCHS):
        store.write(spark.createDataFrame(e, SCHEMA), i)
    assert rows(store) == WANT
    store.write(spark.createDataFrame(EPOCHS[1], SCHEMA), 1)            # a replay
    assert rows(store) == WANT
    store.compact()
    assert rows(store) == WANT
    store.write(spark.createDataFrame([(1, 9, 9.0, 11), (5, 1, 1.0, 1)], SCHEMA), 3)     # late and older, and new
    assert rows(store) == [*WANT, (5, 1, 1.0, 1)]

    streamed = MergeStore(spark, tmpdir_path + "/b", ["guid"], ["at"], buckets=3)
    source = tmpdir_path + "/in"
    for i, e in enumerate(EPOCHS):
        spark.createDataFrame(e, SCHEMA).coalesce(1).write.parquet(f"{source}/t{i}.parquet")
        q = (spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
             .writeStream.foreachBatch(streamed.write).option("checkpointLocation", tmpdir_path + "/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        if i == 1:
            streamed.compact()
    assert rows(streamed) == WANT


def test_a_property_that_a_batch_does_not_have_stays_and_a_null_removes(spark, tmpdir_path):
    store = MergeStore(spark, tmpdir_path + "/c", ["guid"], ["at"])
    store.write(spark.createDataFrame([(1, 0, 5.0, 1), (2, 0, 6.0, 1)], SCHEMA), 0)
    store.write(spark.createDataFrame([(1, 1, 2)], "guid long, flag int, at int"), 1)
    store.write(spark.createDataFrame([(2, None, 3, "x")], "guid long, amount double, at int, note string"), 2)
    got = {r["guid"]: r.asDict() for r in store.read().collect()}
    assert got[1] == {"guid": 1, "flag": 1, "amount": 5.0, "at": 2, "note": None}
    assert got[2] == {"guid": 2, "flag": 0, "amount": None, "at": 3, "note": "x"}


def test_edges_by_two_keys_and_an_uncommitted_delta(spark, tmpdir_path):
    store = MergeStore(spark, tmpdir_path + "/d", ["start_guid", "end_guid"], ["date"])
    df = spark.range(100).select((F.col("id") % 5).alias("start_guid"), (F.col("id") % 4).alias("end_guid"),
                                 F.col("id").alias("date"), (F.col("id") * 2).alias("amount"))
    store.write(df, 0)
    # a delta whose write ended before its manifest row does not count
    df.withColumn("amount", F.lit(-1).cast("long")).write.parquet(os.path.join(tmpdir_path, "d/delta/_epoch=1"))
    got = {(r["start_guid"], r["end_guid"]): r["amount"] for r in store.read().collect()}
    assert len(got) == 20 and got[(4, 3)] == 198 and min(got.values()) >= 160
