"""A list of two is compared, however many longer lists its members are in."""

from riskgraph.llm.minhash_bottomk import HUBS, _star


def test_every_list_of_two_is_paired(spark):
    # 100 is in more long lists, of other hubs each, than it meets hubs of;
    # 50, the hub of a list of two, it meets there alone
    rows = [(s, 10, f"long{h}") for h in range(HUBS + 3) for s in (h, 100, 300 + h)] + [(100, 10, "two"), (50, 10, "two")]
    pairs = _star(spark.createDataFrame(rows, "sig long, n long, key string"))
    got = {(r["a"], r["b"]) for r in pairs.collect()}
    assert (50, 100) in got
    assert sum(100 in p for p in got) == HUBS + 1               # longer lists: what is left apart is found later
