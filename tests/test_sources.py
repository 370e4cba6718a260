import gzip
import os

import pytest

from riskgraph.sources import files
from riskgraph.sources.schema import classify


def test_table_of_strips_all_suffixes():
    assert files.table_of("/x/user.csv") == "user"
    assert files.table_of("/x/p2p.csv.gz") == "p2p"
    assert files.table_of("s3a://b/k/card.csv") == "cards"
    with pytest.raises(files.UnknownTableError):
        files.table_of("/x/accounts.csv")


def test_classify():
    assert classify("user") == "node" and classify("cards") == "node" and classify("card") == "node"
    assert classify("has_cc") == "edge" and classify("referred") == "edge"
    assert classify("weird") == "unknown"


def _write_csv_dir(d):
    with open(os.path.join(d, "user.csv"), "w") as f:
        f.write("u1,1,10.5\nu2,0,\n")
    with gzip.open(os.path.join(d, "p2p.csv.gz"), "wt") as f:
        f.write("u1,User,u2,User,12.5,2020-01-02T03:04:05\n")
    return d


def test_csv_round_trip_and_parquet(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "csv"))
    _write_csv_dir(os.path.join(tmpdir_path, "csv"))
    u = files.read_table_csv(spark, os.path.join(tmpdir_path, "csv", "user.csv"))
    assert u.columns == ["guid", "fraudMoneyTransfer", "moneyTransferErrorCancelAcmount"]
    rows = sorted(u.collect())
    assert rows[0].guid == "u1" and rows[0].fraudMoneyTransfer == 1 and rows[0].moneyTransferErrorCancelAcmount == 10.5
    assert rows[1].moneyTransferErrorCancelAcmount is None
    p = files.read_table_csv(spark, os.path.join(tmpdir_path, "csv", "p2p.csv.gz"))
    r = p.collect()[0]
    assert r.totalAmount == 12.5 and r.transactionDateTime.year == 2020
    out = os.path.join(tmpdir_path, "pq")
    written = files.convert_csv_dir(spark, os.path.join(tmpdir_path, "csv"), out)
    assert set(written) == {"user", "p2p"}
    assert spark.read.parquet(written["user"]).count() == 2
    found = files.discover(spark, out)
    assert [t for t, _ in found["nodes"]] == ["user"]
    assert [t for t, _ in found["edges"]] == ["p2p"]


def test_unknown_csv_is_an_error(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "accounts.csv"), "w") as f:
        f.write("a,b\n")
    with pytest.raises(files.UnknownTableError):
        files.convert_csv_dir(spark, d, os.path.join(tmpdir_path, "out"))


def test_discover_skips_unknown(spark, tmpdir_path):
    df = spark.createDataFrame([("a",)], "guid string")
    files.write_table(df, tmpdir_path, "ip")
    df.write.parquet(os.path.join(tmpdir_path, "misc.parquet"))
    found = files.discover(spark, tmpdir_path)
    assert [t for t, _ in found["nodes"]] == ["ip"]
    assert [t for t, _ in found["unknown"]] == ["misc"]


def test_export_csv_headerless(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = files.export_csv(df, os.path.join(tmpdir_path, "out"))
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert text.strip() == "1,x"


def test_row_counts_and_rollup(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    rc = {r.tableName: r.rowCount for r in files.row_counts({"a": a, "b": b}).collect()}
    assert rc == {"a": 2, "b": 1}
    lt = files.load_totals({"a": a, "b": b}, {"a": "node", "b": "edge"}).collect()
    total = [r.rowCount for r in lt if r.kind is None and r.tableName is None]
    assert total == [3]
