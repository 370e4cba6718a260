"""DuckDB SQL for every oracle-checked query, over the raw test tables.

Each query is the graph overlay of FIXTURES.md plus the stage CTEs it needs,
assembled from named fragments (dependencies resolved in order). The SQL
is independent of the Spark code: plain joins and aggregates, a recursive
CTE for component labels (propagating smaller labels) and one carrying the
PageRank round number and what each round pushed.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTE: dict[str, tuple[list[str], str]] = {}


def _cte(name, deps, body):
    CTE[name] = (deps, body)


_cte("g_user", [], """
SELECT c_custkey AS guid,
       CASE WHEN c_custkey % 53 = 7 THEN 1 ELSE 0 END AS fraudMoneyTransfer,
       c_acctbal AS moneyTransferErrorCancelAmount
FROM customer""")
_cte("g_has_cc", [], """
SELECT o_custkey AS start_guid,
       concat('C', CAST(floor(o_custkey / 3) AS BIGINT), '-', l_partkey % 4) AS end_guid,
       l_shipdate AS cardDate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R'""")
_cte("g_used", [], """
SELECT o_custkey AS start_guid,
       CASE WHEN l_suppkey % 6 = 5 THEN concat('DH', CAST(floor(o_custkey / 50) AS BIGINT))
            ELSE concat('D', CAST(floor(o_custkey / 5) AS BIGINT), '-', l_suppkey % 6) END AS end_guid,
       l_shipdate AS deviceDate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'A'""")
_cte("g_has_ip", [], """
SELECT o_custkey AS start_guid, concat('I', l_suppkey) AS end_guid, l_shipdate AS ipDate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'N'""")
_cte("g_p2p_raw", [], """
SELECT o_custkey AS start_guid, o_custkey + 1 + o_orderkey % 4 AS end_guid,
       o_totalprice AS totalAmount, o_orderdate AS transactionDateTime, o_orderkey
FROM orders WHERE o_orderstatus = 'P'""")
_cte("g_p2p", ["g_p2p_raw", "g_user"], """
SELECT start_guid, end_guid, totalAmount, transactionDateTime FROM g_p2p_raw
WHERE start_guid IN (SELECT guid FROM g_user) AND end_guid IN (SELECT guid FROM g_user)""")
_cte("g_referred", ["g_user"], """
SELECT start_guid, end_guid FROM (
  SELECT c_custkey AS start_guid, CAST(floor(c_custkey / 2) AS BIGINT) AS end_guid
  FROM customer WHERE c_custkey % 3 = 0 AND c_custkey > 0) r
WHERE start_guid IN (SELECT guid FROM g_user) AND end_guid IN (SELECT guid FROM g_user)""")
_cte("g_card", ["g_has_cc"], "SELECT DISTINCT end_guid AS guid FROM g_has_cc")
_cte("g_device", ["g_used"], "SELECT DISTINCT end_guid AS guid FROM g_used")
_cte("g_ip", ["g_has_ip"], "SELECT DISTINCT end_guid AS guid FROM g_has_ip")
_cte("g_id", ["g_has_cc", "g_used", "g_has_ip"], """
SELECT start_guid, end_guid, 'HAS_CC' AS rel, 'Card' AS end_label FROM g_has_cc
UNION ALL SELECT start_guid, end_guid, 'USED', 'Device' FROM g_used
UNION ALL SELECT start_guid, end_guid, 'HAS_IP', 'IP' FROM g_has_ip""")

# ---- stages ---------------------------------------------------------------
_cte("id_deg", ["g_id", "g_user"], """
SELECT i.end_label AS label, i.end_guid AS guid, count(*) AS degree,
       CAST(sum(u.fraudMoneyTransfer) AS BIGINT) AS flaggedDegree
FROM g_id i JOIN g_user u ON u.guid = i.start_guid
GROUP BY i.end_label, i.end_guid""")
_cte("rule1", ["g_p2p", "g_has_cc"], """
SELECT DISTINCT p.u1 AS start_guid, p.u2 AS end_guid
FROM (SELECT DISTINCT start_guid AS u1, end_guid AS u2 FROM g_p2p WHERE start_guid <> end_guid) p
JOIN g_has_cc a ON a.start_guid = p.u1
JOIN g_has_cc b ON b.start_guid = p.u2 AND b.end_guid = a.end_guid""")
_cte("low_mem", ["g_id", "id_deg"], """
SELECT DISTINCT i.start_guid AS u, concat(i.end_label, ' ', i.end_guid) AS id
FROM g_id i JOIN id_deg d ON d.label = i.end_label AND d.guid = i.end_guid
WHERE i.rel IN ('HAS_CC', 'USED') AND d.degree <= 10""")
_cte("id_mem", ["g_id"], "SELECT DISTINCT start_guid AS u, concat(end_label, ' ', end_guid) AS id FROM g_id")
_cte("rule2", ["low_mem", "id_mem"], """
SELECT c.u1 AS start_guid, c.u2 AS end_guid
FROM (SELECT DISTINCT a.u AS u1, b.u AS u2 FROM low_mem a JOIN low_mem b ON a.id = b.id AND a.u < b.u) c
JOIN id_mem a ON a.u = c.u1
JOIN id_mem b ON b.u = c.u2 AND b.id = a.id
GROUP BY c.u1, c.u2
HAVING count(DISTINCT a.id) > 2""")
_cte("er_und", ["rule1", "rule2"], """
SELECT start_guid AS s, end_guid AS d FROM rule1 UNION SELECT end_guid, start_guid FROM rule1
UNION SELECT start_guid, end_guid FROM rule2 UNION SELECT end_guid, start_guid FROM rule2""")
_cte("lab", ["g_user", "er_und"], """
SELECT guid AS node, guid AS comp FROM g_user
UNION
SELECT e.d, l.comp FROM lab l JOIN er_und e ON e.s = l.node WHERE l.comp < e.d""")
_cte("wccl", ["lab"], "SELECT node AS guid, min(comp) AS wccId FROM lab GROUP BY node")
_cte("ur", ["g_user", "wccl"], """
SELECT u.guid, u.fraudMoneyTransfer, w.wccId,
       CASE WHEN w.wccId IN (SELECT w2.wccId FROM wccl w2 JOIN g_user u2 ON u2.guid = w2.guid
                             WHERE u2.fraudMoneyTransfer = 1) THEN 1 ELSE 0 END AS fraudRisk
FROM g_user u JOIN wccl w ON w.guid = u.guid""")
_cte("risk_deg", ["g_id", "ur"], """
SELECT i.end_label AS label, i.end_guid AS guid, count(*) AS degree,
       CAST(sum(u.fraudMoneyTransfer) AS BIGINT) AS flaggedDegree,
       CAST(sum(u.fraudRisk) AS BIGINT) AS fraudRiskDegree
FROM g_id i JOIN ur u ON u.guid = i.start_guid
GROUP BY i.end_label, i.end_guid""")
_cte("touched", ["g_id", "ur"], """
SELECT DISTINCT i.end_label AS label, i.end_guid AS guid FROM g_id i JOIN ur ON ur.guid = i.start_guid WHERE ur.fraudRisk = 1""")
_cte("fsi", ["g_id", "touched", "id_deg"], """
SELECT i.start_guid, i.end_guid, i.end_label,
       CASE WHEN d.degree = 1 THEN CAST('inf' AS DOUBLE) ELSE 1.0 / (d.degree - 1.0) END AS w
FROM g_id i JOIN touched t ON t.label = i.end_label AND t.guid = i.end_guid
JOIN id_deg d ON d.label = i.end_label AND d.guid = i.end_guid""")
_cte("sm", ["fsi"], "SELECT start_guid AS node, concat(end_label, ' ', end_guid) AS item, max(w) AS w FROM fsi GROUP BY 1, 2")
_cte("smw", ["sm"], "SELECT node, sum(w) AS W FROM sm GROUP BY node")
_cte("sim", ["sm", "smw"], """
SELECT node1, node2, similarity FROM (
  SELECT s.*, row_number() OVER (PARTITION BY node1 ORDER BY round(similarity, 9) DESC, node2) AS rn
  FROM (SELECT p.a AS node1, p.b AS node2, p.I / (wa.W + wb.W - p.I) AS similarity
        FROM (SELECT a.node AS a, b.node AS b, sum(least(a.w, b.w)) AS I
              FROM sm a JOIN sm b ON a.item = b.item AND a.node <> b.node GROUP BY 1, 2) p
        JOIN smw wa ON wa.node = p.a JOIN smw wb ON wb.node = p.b) s
  WHERE similarity >= 0.01) t
WHERE rn <= 10""")
_cte("pp", ["g_p2p"], "SELECT start_guid AS s, end_guid AS d, sum(totalAmount) AS amt FROM g_p2p GROUP BY 1, 2")
_cte("pre", ["pp", "rule1"], """
SELECT 'pagerank_p2p_sent' AS v, s AS src, d AS dst, 1.0 AS w FROM pp
UNION ALL SELECT 'pagerank_p2p_received', d, s, 1.0 FROM pp
UNION ALL SELECT 'pagerank_shared_card', start_guid, end_guid, 1.0 FROM rule1
UNION ALL SELECT 'pagerank_shared_card_reverse', end_guid, start_guid, 1.0 FROM rule1
UNION ALL SELECT 'pagerank_weighted_p2p_sent', s, d, amt FROM pp WHERE amt > 0
UNION ALL SELECT 'pagerank_weighted_p2p_received', d, s, amt FROM pp WHERE amt > 0""")
_cte("pe", ["pre"], "SELECT v, src, dst, w / sum(w) OVER (PARTITION BY v, src) AS sh FROM pre")
_cte("vv", [], """
SELECT v FROM (VALUES ('pagerank_p2p_sent'), ('pagerank_p2p_received'), ('pagerank_shared_card'),
                      ('pagerank_shared_card_reverse'), ('pagerank_weighted_p2p_sent'),
                      ('pagerank_weighted_p2p_received')) t(v)""")
# what reaches a user in round ``it``; whoever got more than the tolerance sends it on
_cte("push", ["g_user", "vv", "pe"], """
SELECT 0 AS it, v, guid, CAST(0.15 AS DOUBLE) AS r FROM g_user, vv
UNION ALL
SELECT p.it + 1, p.v, e.dst, 0.85 * sum(p.r * e.sh)
FROM push p JOIN pe e ON e.v = p.v AND e.src = p.guid
WHERE p.r > 1e-7 AND p.it < 1000 GROUP BY p.it, p.v, e.dst""")
_cte("prf", ["push"], "SELECT v, guid, sum(r) AS pagerank FROM push GROUP BY v, guid")
_cte("uid_deg", ["g_user", "g_id"], """
SELECT u.guid,
       count(*) FILTER (WHERE i.rel = 'HAS_CC') AS cardDegree,
       count(*) FILTER (WHERE i.rel = 'USED') AS deviceDegree,
       count(*) FILTER (WHERE i.rel = 'HAS_IP') AS ipDegree
FROM g_user u LEFT JOIN g_id i ON i.start_guid = u.guid GROUP BY u.guid""")
_cte("p2p_deg", ["g_user", "pp"], """
SELECT u.guid,
       (SELECT count(*) FROM pp WHERE pp.s = u.guid) AS p2pSentDegree,
       (SELECT count(*) FROM pp WHERE pp.d = u.guid) AS p2pReceivedDegree,
       coalesce((SELECT sum(amt) FROM pp WHERE pp.s = u.guid AND amt > 0), 0.0) AS p2pSentWeightedDegree,
       coalesce((SELECT sum(amt) FROM pp WHERE pp.d = u.guid AND amt > 0), 0.0) AS p2pReceivedWeightedDegree
FROM g_user u""")
_cte("sid_deg", ["g_user", "rule2"], """
SELECT u.guid, (SELECT count(*) FROM rule2 r WHERE r.start_guid = u.guid OR r.end_guid = u.guid) AS sharedIdsDegree
FROM g_user u""")
_cte("cfeat", ["wccl"], """
SELECT guid, wccId, count(*) OVER (PARTITION BY wccId) AS communitySize,
       CAST(count(*) OVER (PARTITION BY wccId) > 1 AS INTEGER) AS partOfCommunity
FROM wccl""")
_cte("feat", ["ur", "sid_deg", "rule1", "p2p_deg", "uid_deg", "cfeat", "prf"], """
SELECT ur.guid, ur.fraudMoneyTransfer, ur.wccId, ur.fraudRisk,
  sd.sharedIdsDegree,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_shared_card') AS p2pSharedCardPageRank,
  (SELECT count(*) FROM rule1 WHERE rule1.start_guid = ur.guid) AS p2pSharedCardDegree,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_shared_card_reverse') AS p2pReversedSharedCardPageRank,
  (SELECT count(*) FROM rule1 WHERE rule1.end_guid = ur.guid) AS p2pReversedSharedCardDegree,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_p2p_sent') AS p2pSentPageRank,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_weighted_p2p_sent') AS p2pSentWeightedPageRank,
  pd.p2pSentWeightedDegree, pd.p2pSentDegree,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_p2p_received') AS p2pReceivedPageRank,
  (SELECT pagerank FROM prf WHERE prf.guid = ur.guid AND v = 'pagerank_weighted_p2p_received') AS p2pReceivedWeightedPageRank,
  pd.p2pReceivedWeightedDegree, pd.p2pReceivedDegree,
  ud.cardDegree, ud.deviceDegree, ud.ipDegree, cf.communitySize, cf.partOfCommunity
FROM ur JOIN sid_deg sd ON sd.guid = ur.guid JOIN p2p_deg pd ON pd.guid = ur.guid
JOIN uid_deg ud ON ud.guid = ur.guid JOIN cfeat cf ON cf.guid = ur.guid""")
_cte("ln", ["g_user", "g_card", "g_device", "g_ip"], """
SELECT label, guid, row_number() OVER (ORDER BY label, guid) - 1 AS id FROM (
  SELECT 'User' AS label, CAST(guid AS VARCHAR) AS guid FROM g_user UNION ALL SELECT 'Card', guid FROM g_card
  UNION ALL SELECT 'Device', guid FROM g_device UNION ALL SELECT 'IP', guid FROM g_ip) t""")
_cte("le", ["ln", "g_id", "g_p2p"], """
SELECT src, dst, sum(w) AS w FROM (
  SELECT u.id AS src, i.id AS dst, 1.0::DOUBLE AS w FROM g_id e
  JOIN ln u ON u.label = 'User' AND u.guid = CAST(e.start_guid AS VARCHAR)
  JOIN ln i ON i.label = e.end_label AND i.guid = e.end_guid WHERE e.rel IN ('HAS_CC', 'USED')
  UNION ALL
  SELECT i.id, u.id, 1.0 FROM g_id e
  JOIN ln u ON u.label = 'User' AND u.guid = CAST(e.start_guid AS VARCHAR)
  JOIN ln i ON i.label = e.end_label AND i.guid = e.end_guid WHERE e.rel IN ('HAS_CC', 'USED')
  UNION ALL
  SELECT a.id, b.id, CASE WHEN a.id = b.id THEN 1.0 ELSE 0.5 END FROM (SELECT DISTINCT start_guid, end_guid FROM g_p2p) p
  JOIN ln a ON a.label = 'User' AND a.guid = CAST(p.start_guid AS VARCHAR)
  JOIN ln b ON b.label = 'User' AND b.guid = CAST(p.end_guid AS VARCHAR)
  UNION ALL
  SELECT b.id, a.id, 0.5 FROM (SELECT DISTINCT start_guid, end_guid FROM g_p2p) p
  JOIN ln a ON a.label = 'User' AND a.guid = CAST(p.start_guid AS VARCHAR)
  JOIN ln b ON b.label = 'User' AND b.guid = CAST(p.end_guid AS VARCHAR) WHERE a.id <> b.id) t
GROUP BY src, dst""")
_cte("lc", ["ln", "g_id"], """
SELECT id AS node, CAST(floor(CAST(guid AS BIGINT) / 15) AS BIGINT) AS c FROM ln WHERE label = 'User'
UNION ALL
SELECT n.id, CAST(floor(min(e.start_guid) / 15) AS BIGINT) FROM ln n
JOIN g_id e ON e.end_label = n.label AND e.end_guid = n.guid WHERE n.label IN ('Card', 'Device') GROUP BY n.id""")
_cte("nb_raw", [], """
SELECT o_custkey + (o_orderkey % 2) * 1000000 AS guid,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS fraudMoneyTransfer,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS moneyTransferErrorCancelAmount,
       o_orderdate AS lastOrderDate, o_orderkey AS seq
FROM orders""")
_cte("nb", ["nb_raw"], """
SELECT guid, fraudMoneyTransfer, moneyTransferErrorCancelAmount, lastOrderDate FROM nb_raw
QUALIFY row_number() OVER (PARTITION BY guid ORDER BY lastOrderDate DESC, seq DESC) = 1""")
_cte("fscore", ["ur", "g_id", "risk_deg"], """
SELECT ur.guid, ur.fraudRisk AS label,
       round(coalesce((SELECT avg(CAST(d.fraudRiskDegree AS DOUBLE) / d.degree) FROM g_id i
                       JOIN risk_deg d ON d.label = i.end_label AND d.guid = i.end_guid
                       WHERE i.start_guid = ur.guid), 0.0) + 1e-9, 6) AS score
FROM ur""")
_cte("curve", ["fscore"], """
SELECT threshold,
       CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
       CAST(sum(n - pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
       sum(pos) OVER () AS P, sum(n - pos) OVER () AS N
FROM (SELECT score AS threshold, sum(label) AS pos, count(*) AS n FROM fscore GROUP BY 1) s""")


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order)
    return f"WITH RECURSIVE {body}\n"


def _q(deps, select):
    return _with(*deps) + select


def _buckets(src, label, num, out):
    return _q([src], f"""
SELECT b AS {out}, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 3) AS percentCount
FROM (SELECT CASE WHEN {num} = 0 THEN '0' WHEN {num} = degree THEN '1' ELSE 'Between 0-1' END AS b
      FROM {src} WHERE label = '{label}' AND degree > 1) x
GROUP BY b""")


def _dist(src_select, count_name, pct_digits=None):
    q = "x" if pct_digits is None else f"round(x, {pct_digits})"
    return f"""
SELECT count(*) AS {count_name}, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean,
       round(quantile_cont({q}, 0.5), 6) AS p50, round(quantile_cont({q}, 0.75), 6) AS p75,
       round(quantile_cont({q}, 0.9), 6) AS p90, round(quantile_cont({q}, 0.95), 6) AS p95,
       round(quantile_cont({q}, 0.99), 6) AS p99
FROM ({src_select}) s"""


_SHARE_BASE = """
SELECT p.totalAmount, p.start_guid, p.end_guid, a.fraudMoneyTransfer AS f1, a.fraudRisk AS r1,
       b.fraudMoneyTransfer AS f2, b.fraudRisk AS r2
FROM g_p2p p JOIN ur a ON a.guid = p.start_guid JOIN ur b ON b.guid = p.end_guid"""

_TOP_COMMUNITY = """(SELECT w.wccId FROM wccl w JOIN g_user u ON u.guid = w.guid GROUP BY w.wccId
 ORDER BY sum(u.fraudMoneyTransfer) DESC, w.wccId LIMIT 1)"""

_FEATURES = [
    "sharedIdsDegree", "p2pSharedCardPageRank", "p2pSharedCardDegree", "p2pReversedSharedCardPageRank",
    "p2pReversedSharedCardDegree", "p2pSentPageRank", "p2pSentWeightedPageRank", "p2pSentWeightedDegree",
    "p2pSentDegree", "p2pReceivedPageRank", "p2pReceivedWeightedPageRank", "p2pReceivedWeightedDegree",
    "p2pReceivedDegree", "cardDegree", "deviceDegree", "ipDegree", "communitySize", "partOfCommunity",
]
_FEATURES_10 = ["sharedIdsDegree", "p2pSharedCardPageRank", "p2pSentPageRank", "p2pReceivedWeightedPageRank",
                "p2pReceivedWeightedDegree", "ipDegree", "cardDegree", "deviceDegree", "communitySize",
                "partOfCommunity"]


def _fcol(c):
    if "PageRank" in c:
        return f"round({c} + 1e-9, 6) AS {c}"
    return f"round({c}, 6) AS {c}" if "Weighted" in c else c


def _pr(v):
    return _q(["prf"], f"SELECT guid, round(pagerank + 1e-9, 6) AS pagerank FROM prf WHERE v = '{v}'")


SQL: dict[str, str] = {
    "identifier_degrees": _q(["id_deg"], "SELECT label, guid, degree, flaggedDegree FROM id_deg"),
    "stream_identifier_degrees": _q(["id_deg"], "SELECT label, guid, degree FROM id_deg"),
    "id_ratios": _q(["id_deg"], """
SELECT label, guid, degree, flaggedDegree, round(CAST(flaggedDegree AS DOUBLE) / degree, 6) AS flaggedRatio
FROM id_deg"""),
    "ratio_buckets_card_flagged": _buckets("id_deg", "Card", "flaggedDegree", "flaggedUserRatio"),
    "ratio_buckets_device_flagged": _buckets("id_deg", "Device", "flaggedDegree", "flaggedUserRatio"),
    "row_counts": _q(["g_card", "g_device", "g_ip", "g_user", "g_has_cc", "g_used", "g_has_ip", "g_p2p", "g_referred"], """
SELECT 'cards' AS tableName, count(*) AS rowCount FROM g_card
UNION ALL SELECT 'device', count(*) FROM g_device
UNION ALL SELECT 'ip', count(*) FROM g_ip
UNION ALL SELECT 'user', count(*) FROM g_user
UNION ALL SELECT 'has_cc', count(*) FROM g_has_cc
UNION ALL SELECT 'used', count(*) FROM g_used
UNION ALL SELECT 'has_ip', count(*) FROM g_has_ip
UNION ALL SELECT 'p2p', count(*) FROM g_p2p
UNION ALL SELECT 'referred', count(*) FROM g_referred"""),
    "load_totals": _q(["g_card", "g_device", "g_ip", "g_user", "g_has_cc", "g_used", "g_has_ip", "g_p2p", "g_referred"], """
SELECT kind, tableName, count(*) AS rowCount FROM (
  SELECT 'node' AS kind, 'cards' AS tableName FROM g_card
  UNION ALL SELECT 'node', 'device' FROM g_device
  UNION ALL SELECT 'node', 'ip' FROM g_ip
  UNION ALL SELECT 'node', 'user' FROM g_user
  UNION ALL SELECT 'edge', 'has_cc' FROM g_has_cc
  UNION ALL SELECT 'edge', 'used' FROM g_used
  UNION ALL SELECT 'edge', 'has_ip' FROM g_has_ip
  UNION ALL SELECT 'edge', 'p2p' FROM g_p2p
  UNION ALL SELECT 'edge', 'referred' FROM g_referred) t
GROUP BY ROLLUP (kind, tableName)"""),
    "loaded_graph_counts": _q(["g_card", "g_device", "g_ip", "g_user", "g_has_cc", "g_used", "g_has_ip", "g_p2p", "g_referred"], """
SELECT 'node' AS kind, 'Card' AS name, count(*) AS count FROM g_card
UNION ALL SELECT 'node', 'Device', count(*) FROM g_device
UNION ALL SELECT 'node', 'IP', count(*) FROM g_ip
UNION ALL SELECT 'node', 'User', count(*) FROM g_user
UNION ALL SELECT 'edge', 'HAS_CC', count(*) FROM g_has_cc
UNION ALL SELECT 'edge', 'USED', count(*) FROM g_used
UNION ALL SELECT 'edge', 'HAS_IP', count(*) FROM g_has_ip
UNION ALL SELECT 'edge', 'P2P', count(*) FROM g_p2p
UNION ALL SELECT 'edge', 'REFERRED', count(*) FROM g_referred"""),
    "node_merge_last_wins": _q(["nb"], "SELECT * FROM nb"),
    "node_upsert": _q(["g_user", "nb"], """
SELECT coalesce(e.guid, i.guid) AS guid,
       CASE WHEN i.guid IS NOT NULL THEN i.fraudMoneyTransfer ELSE e.fraudMoneyTransfer END AS fraudMoneyTransfer,
       CASE WHEN i.guid IS NOT NULL THEN i.moneyTransferErrorCancelAmount
            ELSE e.moneyTransferErrorCancelAmount END AS moneyTransferErrorCancelAmount,
       i.lastOrderDate
FROM g_user e FULL OUTER JOIN nb i ON e.guid = i.guid"""),
    "node_merge_epochs": _q(["nb_raw", "nb"], """
SELECT nb.guid, nb.fraudMoneyTransfer, nb.lastOrderDate, a.moneyTransferErrorCancelAmount
FROM nb LEFT JOIN (SELECT guid, moneyTransferErrorCancelAmount FROM nb_raw WHERE seq % 3 <> 1
                   QUALIFY row_number() OVER (PARTITION BY guid ORDER BY lastOrderDate DESC, seq DESC) = 1) a
  ON a.guid = nb.guid"""),
    "node_key_violations": _q(["g_user", "nb_raw"], """
SELECT guid, count(*) AS cnt FROM (SELECT guid FROM g_user UNION ALL SELECT guid FROM nb_raw) t
GROUP BY guid HAVING count(*) > 1"""),
    "edge_match_append": _q(["g_p2p"], "SELECT start_guid, end_guid, totalAmount, transactionDateTime FROM g_p2p"),
    "edge_merge_last_wins": _q(["g_p2p_raw", "g_user"], """
SELECT start_guid, end_guid, totalAmount, transactionDateTime FROM g_p2p_raw
WHERE start_guid IN (SELECT guid FROM g_user) AND end_guid IN (SELECT guid FROM g_user)
QUALIFY row_number() OVER (PARTITION BY start_guid, end_guid
                           ORDER BY transactionDateTime DESC, totalAmount DESC, o_orderkey DESC) = 1"""),
    "stream_edge_merge": _q(["g_p2p_raw", "g_user"], """
SELECT start_guid, end_guid, totalAmount, transactionDateTime FROM g_p2p_raw
WHERE start_guid IN (SELECT guid FROM g_user) AND end_guid IN (SELECT guid FROM g_user)
QUALIFY row_number() OVER (PARTITION BY start_guid, end_guid
                           ORDER BY transactionDateTime DESC, totalAmount DESC, o_orderkey DESC) = 1"""),
    "edge_label_pairs": _q(["g_has_cc", "g_used", "g_has_ip", "g_p2p", "g_referred"], """
SELECT DISTINCT 'has_cc' AS tableName, 'User' AS start_label, 'Card' AS end_label FROM g_has_cc
UNION ALL SELECT DISTINCT 'used', 'User', 'Device' FROM g_used
UNION ALL SELECT DISTINCT 'has_ip', 'User', 'IP' FROM g_has_ip
UNION ALL SELECT DISTINCT 'p2p', 'User', 'User' FROM g_p2p
UNION ALL SELECT DISTINCT 'referred', 'User', 'User' FROM g_referred"""),
    "label_counts": _q(["g_user", "g_card", "g_device", "g_ip"], """
SELECT 'User' AS label, count(*) AS count FROM g_user
UNION ALL SELECT 'Card', count(*) FROM g_card
UNION ALL SELECT 'Device', count(*) FROM g_device
UNION ALL SELECT 'IP', count(*) FROM g_ip"""),
    "reltype_counts": _q(["g_id", "g_p2p", "g_referred"], """
SELECT rel AS type, count(*) AS count FROM g_id GROUP BY rel
UNION ALL SELECT 'P2P', count(*) FROM g_p2p
UNION ALL SELECT 'REFERRED', count(*) FROM g_referred"""),
    "flag_distribution": _q(["g_user"], "SELECT fraudMoneyTransfer, count(*) AS cnt FROM g_user GROUP BY 1"),
    "flagged_users": _q(["g_user"], "SELECT guid FROM g_user WHERE fraudMoneyTransfer = 1"),
    "unwind_range": _q(["uid_deg"], """
SELECT guid, unnest(range(1, cardDegree + 1)) AS x FROM uid_deg WHERE cardDegree > 0"""),
    "projection_orientations": _q(["g_p2p"], """
SELECT 'NATURAL' AS orientation, start_guid AS src, end_guid AS dst, round(totalAmount, 6) AS w FROM g_p2p
UNION ALL SELECT 'REVERSE', end_guid, start_guid, round(totalAmount, 6) FROM g_p2p
UNION ALL SELECT 'UNDIRECTED', start_guid, end_guid, round(totalAmount, 6) FROM g_p2p
UNION ALL SELECT 'UNDIRECTED', end_guid, start_guid, round(totalAmount, 6) FROM g_p2p WHERE start_guid <> end_guid"""),
    "projection_sum": _q(["pp"], "SELECT s AS src, d AS dst, round(amt, 6) AS totalAmount FROM pp"),
    "projection_counts": _q(["g_user", "g_card", "g_device", "g_ip", "g_id", "g_has_cc", "g_used", "pp",
                             "touched", "fsi"], """
SELECT 'id-projection' AS projection,
       (SELECT count(*) FROM g_user) + (SELECT count(*) FROM g_card) + (SELECT count(*) FROM g_device)
         + (SELECT count(*) FROM g_ip) AS nodeCount,
       (SELECT count(*) FROM g_id) AS relationshipCount
UNION ALL
SELECT 'comm-projection',
       (SELECT count(*) FROM g_user) + (SELECT count(*) FROM g_card) + (SELECT count(*) FROM g_device),
       2 * (SELECT count(*) FROM g_has_cc) + 2 * (SELECT count(*) FROM g_used) + (SELECT count(*) FROM pp)
UNION ALL
SELECT 'similarity-projection',
       (SELECT count(*) FROM g_user) + (SELECT count(*) FROM touched),
       (SELECT count(*) FROM fsi)"""),
    "user_id_degrees": _q(["uid_deg"], "SELECT * FROM uid_deg"),
    "p2p_degrees": _q(["p2p_deg"], "SELECT guid, p2pSentDegree, p2pReceivedDegree FROM p2p_deg"),
    "p2p_weighted_degrees": _q(["p2p_deg"], """
SELECT guid, round(p2pSentWeightedDegree, 6) AS p2pSentWeightedDegree,
       round(p2pReceivedWeightedDegree, 6) AS p2pReceivedWeightedDegree FROM p2p_deg"""),
    "er_p2p_shared_card": _q(["rule1"], "SELECT * FROM rule1"),
    "er_shared_ids": _q(["rule2"], "SELECT * FROM rule2"),
    "er_counts": _q(["rule1", "rule2"], """
SELECT 'P2P_WITH_SHARED_CARD' AS rule, count(*) AS pairs FROM rule1
UNION ALL SELECT 'SHARED_IDS', count(*) FROM rule2"""),
    "shared_ids_degree": _q(["sid_deg"], "SELECT * FROM sid_deg"),
    "wcc": _q(["wccl"], "SELECT guid, wccId FROM wccl"),
    "wcc_distribution": _q(["wccl"], _dist("SELECT count(*) AS x FROM wccl GROUP BY wccId", "componentCount")),
    "wcc_size_stats": _q(["ur"], """
SELECT CASE WHEN cSize = 1 THEN ' 1' WHEN cSize = 2 THEN ' 2' WHEN cSize = 3 THEN ' 3'
            WHEN cSize > 3 AND cSize <= 10 THEN ' 4-10' WHEN cSize > 10 AND cSize <= 50 THEN '11-50'
            WHEN cSize > 10 THEN '>50' END AS componentSize,
       count(*) AS numberOfComponents, CAST(sum(cSize) AS BIGINT) AS totalUserCount,
       CAST(sum(cFraudSize) AS BIGINT) AS fraudUserCount
FROM (SELECT wccId, count(*) AS cSize, sum(fraudRisk) AS cFraudSize FROM ur GROUP BY wccId) c
GROUP BY 1 ORDER BY 1"""),
    "fraud_risk_labels": _q(["ur"], "SELECT guid, wccId, fraudRisk FROM ur"),
    "community_report": _q(["ur"], """
SELECT wccId AS community, count(*) AS cnt, CAST(sum(fraudMoneyTransfer) AS BIGINT) AS flaggedCount,
       round(CAST(sum(fraudMoneyTransfer) AS DOUBLE) / count(*), 6) AS flaggedRatio
FROM ur GROUP BY wccId ORDER BY flaggedCount DESC, community LIMIT 100"""),
    "community_subgraph": _q(["wccl", "g_user", "g_id", "g_p2p"], f"""
SELECT 'ID' AS kind, CAST(e.u AS VARCHAR) AS src, e.id AS dst, e.c AS edges, CAST(NULL AS DOUBLE) AS amount
FROM (SELECT start_guid AS u, end_label AS l, end_guid AS id, count(*) AS c FROM g_id
      WHERE start_guid IN (SELECT guid FROM wccl WHERE wccId = {_TOP_COMMUNITY}) GROUP BY 1, 2, 3) e
WHERE (e.l, e.id) IN (SELECT (end_label, end_guid) FROM g_id
                      WHERE start_guid IN (SELECT guid FROM wccl WHERE wccId = {_TOP_COMMUNITY})
                      GROUP BY end_label, end_guid HAVING count(*) >= 2)
UNION ALL
SELECT 'P2P', CAST(start_guid AS VARCHAR), CAST(end_guid AS VARCHAR), count(*), round(sum(totalAmount), 6)
FROM g_p2p
WHERE start_guid IN (SELECT guid FROM wccl WHERE wccId = {_TOP_COMMUNITY})
  AND end_guid IN (SELECT guid FROM wccl WHERE wccId = {_TOP_COMMUNITY})
GROUP BY start_guid, end_guid"""),
    "community_features": _q(["cfeat"], "SELECT guid, wccId, communitySize, partOfCommunity FROM cfeat"),
    "community_size_hist": _q(["wccl"], """
SELECT CAST(floor(log10(community_size) * 10) AS INTEGER) AS bin, count(*) AS numberOfCommunities,
       min(community_size) AS minSize, max(community_size) AS maxSize
FROM (SELECT wccId, count(*) AS community_size FROM wccl GROUP BY wccId HAVING count(*) < 1000) s
GROUP BY 1 ORDER BY 1"""),
    "interesting_users": _q(["cfeat"], """
SELECT guid, wccId, communitySize FROM cfeat WHERE communitySize > 10 AND communitySize < 1000"""),
    "p2p_flagged_share": _q(["g_p2p", "ur"], f"""
SELECT round(riskTotal / p2pTotal, 3) AS p FROM (
  SELECT sum(CASE WHEN (f1 = 1 AND f2 = 0) OR (f2 = 1 AND f1 = 0) THEN totalAmount ELSE 0 END) AS p2pTotal,
         sum(CASE WHEN (f1 = 1 AND f2 = 0 AND r2 = 1) OR (f2 = 1 AND f1 = 0 AND r1 = 1) THEN totalAmount END) AS riskTotal,
         count(*) FILTER (WHERE (f1 = 1 AND f2 = 0 AND r2 = 1) OR (f2 = 1 AND f1 = 0 AND r1 = 1)) AS n
  FROM ({_SHARE_BASE}) t) a
WHERE n > 0"""),
    "p2p_total_share": _q(["g_p2p", "ur"], f"""
SELECT round(riskTotal / p2pTotal, 3) AS p FROM (
  SELECT sum(totalAmount) AS p2pTotal,
         sum(CASE WHEN m > 0 THEN totalAmount * m END) AS riskTotal,
         count(*) FILTER (WHERE m > 0) AS n
  FROM (SELECT totalAmount,
               CASE WHEN start_guid = end_guid THEN CAST(r1 = 1 AND f1 = 0 AS INTEGER)
                    ELSE CAST(r1 = 1 AND f1 = 0 AS INTEGER) + CAST(r2 = 1 AND f2 = 0 AS INTEGER) END AS m
        FROM ({_SHARE_BASE}) b) t) a
WHERE n > 0"""),
    "ratio_buckets_card_risk": _buckets("risk_deg", "Card", "fraudRiskDegree", "fraudRiskRatio"),
    "ratio_buckets_device_risk": _buckets("risk_deg", "Device", "fraudRiskDegree", "fraudRiskRatio"),
    "weighted_degree_top": _q(["g_id", "touched", "ur", "risk_deg"], """
SELECT uid, round(totalIdFraudRisk, 6) AS totalIdFraudRisk, numberFraudRiskIds,
       round(averageFraudIdRisk, 6) AS averageFraudIdRisk FROM (
  SELECT uid, totalIdFraudRisk, numberFraudRiskIds, totalIdFraudRisk / numberFraudRiskIds AS averageFraudIdRisk
  FROM (SELECT left(md5(CAST(i.start_guid AS VARCHAR)), 8) AS uid,
               sum(CAST(d.fraudRiskDegree AS DOUBLE) / d.degree) AS totalIdFraudRisk,
               count(*) AS numberFraudRiskIds
        FROM g_id i JOIN touched t ON t.label = i.end_label AND t.guid = i.end_guid
        JOIN ur ON ur.guid = i.start_guid AND ur.fraudRisk = 0
        JOIN risk_deg d ON d.label = i.end_label AND d.guid = i.end_guid
        GROUP BY 1) g) h
WHERE averageFraudIdRisk >= 0.25
ORDER BY round(totalIdFraudRisk, 9) DESC, uid LIMIT 10"""),
    "fraud_shared_ids": _q(["fsi"], """
SELECT start_guid, end_guid, end_label, round(w, 6) AS inverseDegreeWeight FROM fsi"""),
    "node_similarity": _q(["sim"], "SELECT node1, node2, round(similarity, 6) AS similarity FROM sim"),
    "similarity_distribution": _q(["sim"], _dist("SELECT similarity AS x FROM sim", "relationshipsWritten", 6)),
    "similar_to_communities": _q(["ur", "sim"], """
SELECT userId, communityId, round(score, 6) AS score, round(sum(score) OVER (PARTITION BY userId), 6) AS totalScore,
       count(*) OVER (PARTITION BY userId) AS numberOfCommunities
FROM (SELECT s.node2 AS userId, f.wccId AS communityId, sum(s.similarity) AS score
      FROM sim s
      JOIN (SELECT guid, wccId FROM ur WHERE fraudRisk = 1 AND wccId IN (
              SELECT wccId FROM ur WHERE fraudRisk = 1 GROUP BY wccId HAVING count(*) > 2)) f ON f.guid = s.node1
      JOIN ur n ON n.guid = s.node2 AND n.fraudRisk = 0
      GROUP BY s.node2, f.wccId) t"""),
    "pagerank_p2p_sent": _pr("pagerank_p2p_sent"),
    "pagerank_p2p_received": _pr("pagerank_p2p_received"),
    "pagerank_shared_card": _pr("pagerank_shared_card"),
    "pagerank_shared_card_reverse": _pr("pagerank_shared_card_reverse"),
    "pagerank_weighted_p2p_sent": _pr("pagerank_weighted_p2p_sent"),
    "pagerank_weighted_p2p_received": _pr("pagerank_weighted_p2p_received"),
    "user_feature_table": _q(["feat"], "SELECT guid, fraudMoneyTransfer, wccId, fraudRisk, "
                             + ", ".join(_fcol(c) for c in _FEATURES) + " FROM feat"),
    "accuracy": _q(["fscore"], """
SELECT round(avg(CASE WHEN CAST(score >= 0.5 AS INTEGER) = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM fscore"""),
    "confusion_matrix": _q(["fscore"], """
SELECT label, predicted, cnt, round(cnt / sum(cnt) OVER (PARTITION BY label), 6) AS rate
FROM (SELECT label, CAST(score >= 0.5 AS INTEGER) AS predicted, count(*) AS cnt FROM fscore GROUP BY 1, 2) c"""),
    "roc_points": _q(["curve"], """
SELECT threshold, tp, fp, round(tp / NULLIF(P, 0), 6) AS tpr, round(fp / NULLIF(N, 0), 6) AS fpr FROM curve"""),
    "pr_points": _q(["curve"], """
SELECT threshold, tp, fp, round(tp / NULLIF(tp + fp, 0), 6) AS precision, round(tp / NULLIF(P, 0), 6) AS recall
FROM curve"""),
    "score_write_back": _q(["g_user", "fscore"], """
SELECT u.guid, f.score AS predictedProbability
FROM g_user u LEFT JOIN fscore f ON f.guid = u.guid AND f.score > 0.88 AND f.label = 0"""),
    "permutation_importance_fixed": _q(["ur", "sid_deg", "uid_deg", "cfeat"], """
SELECT feature, round(abs(avg(base - acc)), 6) AS importance FROM (
  SELECT feature, r, avg(CASE WHEN CAST(2 * plain.cs + 3 * plain.sid - plain.cd - plain.dd >= 25 AS INTEGER) = label
                              THEN 1.0 ELSE 0.0 END) AS base,
         avg(CASE WHEN CAST(2 * CASE WHEN feature = 'communitySize' THEN dcs ELSE plain.cs END
                            + 3 * CASE WHEN feature = 'sharedIdsDegree' THEN dsid ELSE plain.sid END
                            - CASE WHEN feature = 'cardDegree' THEN dcd ELSE plain.cd END
                            - CASE WHEN feature = 'deviceDegree' THEN ddd ELSE plain.dd END >= 25 AS INTEGER) = label
                  THEN 1.0 ELSE 0.0 END) AS acc
  FROM (SELECT ur.guid, row_number() OVER (ORDER BY ur.guid) AS n, fraudRisk - fraudMoneyTransfer AS label,
               sharedIdsDegree AS sid, communitySize AS cs, cardDegree AS cd, deviceDegree AS dd
        FROM ur JOIN sid_deg s ON s.guid = ur.guid JOIN uid_deg u ON u.guid = ur.guid
        JOIN cfeat c ON c.guid = ur.guid) plain
  JOIN (SELECT r, row_number() OVER (PARTITION BY r ORDER BY md5(concat('0:', r, ':', ur.guid)), ur.guid) AS n,
               sharedIdsDegree AS dsid, communitySize AS dcs, cardDegree AS dcd, deviceDegree AS ddd
        FROM ur JOIN sid_deg s ON s.guid = ur.guid JOIN uid_deg u ON u.guid = ur.guid
        JOIN cfeat c ON c.guid = ur.guid, (SELECT unnest(range(5)) AS r) reps) donor ON donor.n = plain.n,
       (VALUES ('sharedIdsDegree'), ('communitySize'), ('cardDegree'), ('deviceDegree'), ('ipDegree')) f(feature)
  GROUP BY feature, r) t
GROUP BY feature"""),
    "louvain_modularity": _q(["le", "lc"], """
SELECT round(sum(tot), 6) AS weight, count(*) AS communities,
       round(sum(inside) / sum(tot) - sum(tot * tot) / (sum(tot) * sum(tot)) + 1e-12, 6) AS modularity
FROM (SELECT a.c, sum(CASE WHEN a.c = b.c THEN w ELSE 0 END) AS inside, sum(w) AS tot
      FROM le JOIN lc a ON a.node = le.src JOIN lc b ON b.node = le.dst GROUP BY a.c) per"""),
    "louvain_first_moves": _q(["le", "ln"], """
SELECT n.label, n.guid, t.label AS targetLabel, t.guid AS targetGuid FROM (
  SELECT le.src, le.dst, row_number() OVER (PARTITION BY le.src ORDER BY
           round(le.w / (m.w / 2) - a.k * b.k / (2 * (m.w / 2) * (m.w / 2)), 15) DESC, le.dst) AS rn
  FROM le JOIN (SELECT src, sum(w) AS k FROM le GROUP BY src) a ON a.src = le.src
  JOIN (SELECT src, sum(w) AS k FROM le GROUP BY src) b ON b.src = le.dst, (SELECT sum(w) AS w FROM le) m
  WHERE le.src <> le.dst) x
JOIN ln n ON n.id = x.src JOIN ln t ON t.id = x.dst WHERE rn = 1"""),
    "ml_training_set": _q(["feat"], "SELECT guid, " + ", ".join(_fcol(c) for c in _FEATURES_10)
                          + ", fraudRisk - fraudMoneyTransfer AS label FROM feat"),
}
