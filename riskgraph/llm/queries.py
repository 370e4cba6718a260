"""The registered queries ``op1`` to ``op13``, and the SQL
of those that SQL can express. Each runs its operator with production
parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm import (
    align,
    ann_vptree,
    bpe_tree,
    chat_tree,
    html_lbd,
    lm_backoff,
    minhash_bottomk,
    mixing,
    packing,
    repair,
    topk_balltree,
    toxicity_ws,
    url_filter,
)
from riskgraph.llm.common import table

#: A conversation whose texts hold the control strings themselves.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op1_vptree_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_vptree.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_lbd.extract(table(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lm_backoff.lm_scores(table(spark, sf_dir, "documents"), order=3)
    return s.select("doc_id", "n_words", "n_backoff", "n_unseen", F.round("log_prob", 6).alias("log_prob"),
                    F.round("mean_log_prob", 6).alias("mean_log_prob"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return chat_tree.read_back(chat_tree.format_trees(chat_tree.linear_messages(rows.unionByName(probe))))


def op8_bottomk_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bottomk.near_duplicates(table(spark, sf_dir, "documents"), words=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_ws.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_balltree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_balltree.topk(table(spark, sf_dir, "embeddings"), k=10, every=100)


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files are, on every machine alike."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op11_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                           tokenizer_file("piece_bpe_32k.model"))


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    done = bpe_tree.decode(bpe_tree.encode(table(spark, sf_dir, "documents"), path), path)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    damaged = repair.damage(rows)
    found, missing = repair.summary(repair.repair(damaged)), repair.gaps(damaged)
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]
    ids = rows.select("conv_id").distinct()
    for side in (missing, found):
        other = side.withColumnRenamed("conv_id", "__id")
        ids = ids.join(other, F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    return ids.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *names)],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_vptree_ann, op2_url_filter, op3_html_line_blocks, op4_source_mix, op5_backoff_lm, op6_pack, op7_chat_trees,
    op8_bottomk_neardup, op9_weak_toxicity, op10_balltree_topk, op11_token_spans, op12_bpe_tree, op13_turn_repair)}

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op2_url_filter": r"""
WITH p AS (
  SELECT page_id, url,
         coalesce(""" + _LOWER.format(r"regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)") + r""", '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                            ('allow', 'com/fr/'), ('block', 'com/de/')),
f AS (
  SELECT DISTINCT url, first_value(rule) OVER w AS rule, first_value(verdict) OVER w AS verdict
  FROM (SELECT DISTINCT url, host, path FROM p) JOIN r
    ON starts_with(host || path, rule) OR contains('.' || host || '/', '.' || split_part(rule, '/', 1) || '/')
       AND ends_with('.' || host, '.' || split_part(rule, '/', 1))
       AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))
  WINDOW w AS (PARTITION BY url ORDER BY length(rule) DESC, verdict, rule)),
m AS (
  SELECT url, CASE WHEN regexp_matches(url, '(?si)([^a-z0-9_.%-]|^)(ads|adserver|banner|banners|popup|doubleclick|tracker|login|signup|cart|checkout|casino|porn|xxx|wp-admin|cgi-bin)([^a-z0-9_.%-]|$)|\.(exe|zip)([^a-z0-9_.%-]|$)')
    AND NOT regexp_matches(url, '(?si)([^a-z0-9_.%-]|^)(login[^a-z0-9_.%-]help|ads[^a-z0-9_.%-]policy)([^a-z0-9_.%-]|$)')
    THEN 'block' ELSE 'allow' END AS verdict
  FROM (SELECT DISTINCT url FROM p))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, m.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.url = f.url LEFT JOIN m ON p.url = m.url""",

    "op4_source_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(""" + _WORDS.format("text") + r""")::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
t AS (SELECT sum(source_size)::BIGINT AS total FROM s),
fill(round, source, source_size, weight, clamped) AS (
  SELECT 0, source, source_size, weight, false FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         clamped OR weight * (total - coalesce(sum(CASE WHEN clamped THEN 3 * source_size END) OVER (), 0))
                    > 3 * source_size * coalesce(sum(CASE WHEN NOT clamped THEN weight END) OVER (), 0)
  FROM fill, t WHERE round < (SELECT count(*) FROM s)),
last AS (SELECT * FROM fill WHERE round = (SELECT count(*) FROM s)),
g AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN (3 * source_size)::DOUBLE
              ELSE (weight * (total - coalesce(sum(CASE WHEN clamped THEN 3 * source_size END) OVER (), 0)))::DOUBLE
                   / (sum(CASE WHEN NOT clamped THEN weight END) OVER ())::DOUBLE END AS target
  FROM last, t),
h AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole FROM g),
c AS (
  SELECT d.doc_id, d.size, h.source_size, h.target, h.whole,
         floor(h.target)::BIGINT - h.whole * h.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, size, source_size, target,
       (size * whole + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM c""",

    "op5_backoff_lm": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         """ + _WORDS.format(_LOWER.format("text")) + r""" AS words FROM documents),
w AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
b AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS c,
             lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS e FROM w),
g AS (SELECT r, 1 AS n, [w] AS g FROM b
      UNION ALL SELECT r, 2, [c, w] FROM b WHERE i > 1
      UNION ALL SELECT r, 3, [e, c, w] FROM b WHERE i > 2),
own AS (SELECT r, g, count(*) AS n FROM g GROUP BY r, g),
rest AS (SELECT r, g, sum(n) OVER (PARTITION BY g) - n AS n FROM own),
t AS (SELECT count(*) AS n FROM b),
x AS (
  SELECT b.r, b.i, r1.n AS n1, r2.n AS n2, r3.n AS n3, c1.n AS c1, c2.n AS c2, t.n - len(d.words) AS others
  FROM b JOIN d ON d.r = b.r CROSS JOIN t
  LEFT JOIN rest r1 ON r1.r = b.r AND r1.g = [b.w] LEFT JOIN rest c1 ON c1.r = b.r AND c1.g = [b.c]
  LEFT JOIN rest r2 ON r2.r = b.r AND r2.g = [b.c, b.w] LEFT JOIN rest c2 ON c2.r = b.r AND c2.g = [b.e, b.c]
  LEFT JOIN rest r3 ON r3.r = b.r AND r3.g = [b.e, b.c, b.w]),
s AS (
  SELECT r, count(*) FILTER ((i = 2 AND n2 = 0) OR (i > 2 AND n3 = 0)) AS n_backoff,
         count(*) FILTER (n1 = 0) AS n_unseen,
         sum(CASE WHEN i > 2 AND n3 > 0 THEN ln(n3::DOUBLE / c2)
                  WHEN i > 1 AND n2 > 0 THEN ln(n2::DOUBLE / c1) + CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
                  ELSE ln(greatest(n1, 1)::DOUBLE / greatest(others, 1)) + least(i - 1, 2) * ln(0.4) END) AS lp
  FROM x GROUP BY r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
       coalesce(n_unseen, 0)::BIGINT AS n_unseen, round(coalesce(lp, 0.0), 6) AS log_prob,
       CASE WHEN len(d.words) > 0 THEN round(lp / len(d.words), 6) END AS mean_log_prob
FROM d LEFT JOIN s ON s.r = d.r""",

    "op7_chat_trees": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '""" + PROBE + r"""'
  UNION ALL SELECT -1, 1, 'assistant', '""" + PROBE + r"""'),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*\|')) AS escaped,
         length(role) + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(role, '[\\\n]')) AS head
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + head + 1 + escaped + 10 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",

    "op8_bottomk_neardup": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, """ + _WORDS.format(_LOWER.format("text")) + r""" AS words FROM documents),
s AS (
  SELECT DISTINCT r, words[i] || ' ' || words[i + 1] AS g
  FROM (SELECT r, words, unnest(range(1, len(words))) AS i FROM d WHERE len(words) >= 2)
  UNION ALL SELECT r, words[1] FROM d WHERE len(words) = 1),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM pairs JOIN n na ON na.r = x JOIN n nb ON nb.r = y
  WHERE 100 * inter >= 80 * (na.n + nb.n - inter)),
twoway AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT r, r FROM d UNION SELECT reach.x, twoway.y FROM reach JOIN twoway ON twoway.x = reach.y),
comp AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id,
       coalesce(d.doc_id = component_id, component_id IS NULL) AS kept
FROM d JOIN comp ON comp.x = d.r LEFT JOIN n ON n.r = d.r""",

    "op10_balltree_topk": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 10""",
}
