from riskgraph.sources import sinks


def test_upsert_null_overwrites_and_keeps_old_only_columns(spark):
    old = spark.createDataFrame([(1, 0, 5.0, "a"), (2, 0, 6.0, "b")], "guid long, flag int, amt double, note string")
    new = spark.createDataFrame([(2, 1, None), (3, 1, 7.0)], "guid long, flag int, amt double")
    out = {r.guid: r for r in sinks.upsert_nodes(old, new).collect()}
    assert out[1].flag == 0 and out[1].amt == 5.0 and out[1].note == "a"
    assert out[2].flag == 1 and out[2].amt is None and out[2].note == "b"   # null overwrites
    assert out[3].flag == 1 and out[3].note is None


def test_key_violations_dup_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "guid long")
    assert [(r.guid, r.cnt) for r in sinks.key_violations(df).collect()] == [(1, 2)]


def test_merge_nodes_last_row_wins(spark):
    old = spark.createDataFrame([(1, 0, 5.0)], "guid long, flag int, amt double")
    batch = spark.createDataFrame([(1, 1, 9.0, 1), (1, 0, None, 2), (4, 1, 1.0, 1)],
                                  "guid long, flag int, amt double, seq int")
    out = {r.guid: r for r in sinks.merge_nodes(old, batch, ["seq"]).collect()}
    assert out[1].flag == 0 and out[1].amt is None     # last row, null removes
    assert out[4].flag == 1


def test_attach_edges_drops_missing_endpoint_keeps_parallel(spark):
    users = spark.createDataFrame([(1,), (2,)], "guid long")
    e = spark.createDataFrame([(1, 2, 1.0), (1, 2, 2.0), (1, 9, 3.0)], "start_guid long, end_guid long, amt double")
    out = sinks.attach_edges(e, users, users).collect()
    assert sorted(r.amt for r in out) == [1.0, 2.0]


def test_merge_edges_collapses_parallel(spark):
    users = spark.createDataFrame([(1,), (2,)], "guid long")
    e = spark.createDataFrame([(1, 2, 1.0, 1), (1, 2, 2.0, 2), (2, 1, 5.0, 1)],
                              "start_guid long, end_guid long, amt double, ts int")
    out = {(r.start_guid, r.end_guid): r.amt for r in sinks.merge_edges(e, users, users, ["ts"]).collect()}
    assert out == {(1, 2): 2.0, (2, 1): 5.0}


def test_endpoint_labels_and_write_back(spark):
    e = spark.createDataFrame([("u", "User", "c", "Card")], "start_guid string, start_label string, end_guid string, end_label string")
    assert [tuple(r) for r in sinks.endpoint_labels(e).collect()] == [("User", "Card")]
    users = spark.createDataFrame([(1, None), (2, 0.5)], "guid long, p double")
    scores = spark.createDataFrame([(1, 0.9)], "guid long, p double")
    out = {r.guid: r.p for r in sinks.write_back(users, scores, "p").collect()}
    assert out == {1: 0.9, 2: 0.5}


def test_unwind_batches_then_merge(spark):
    df = spark.createDataFrame(
        [([(1, 0, 1), (2, 1, 1)],), ([(1, 1, 2)],)],
        "batches array<struct<guid:long,flag:int,seq:int>>")
    rows = sinks.unwind_batches(df)
    assert rows.columns == ["guid", "flag", "seq"] and rows.count() == 3
    old = spark.createDataFrame([(3, 0)], "guid long, flag int")
    out = {r.guid: r.flag for r in sinks.merge_nodes(old, rows, ["seq"]).collect()}
    assert out == {1: 1, 2: 1, 3: 0}


def test_timestamp_normalisation(spark):
    from riskgraph.sources.files import normalise_timestamps
    df = spark.createDataFrame([("2020-01-02 03:04:05",)], "transactionDateTime string")
    out = normalise_timestamps(df)
    assert dict(out.dtypes)["transactionDateTime"] == "timestamp"
    assert out.first().transactionDateTime.hour == 3
