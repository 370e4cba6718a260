"""URL filters by pattern rules that are indexed by their rarest literal token.

A rule is a host rule (``allow`` / ``block``, a host and the start of a path;
it fits the host and its subdomains) or a pattern (``block`` or ``except``,
with ``*`` for anything and ``^`` for a separator, on the whole URL). Each rule
has literal tokens: runs of a-z and 0-9 that are delimited on both sides in
the rule, so that every URL it fits has them as whole tokens. The rules' tokens
are counted in the given URLs and each rule is indexed under its rarest one;
a URL's tokens fetch candidate rules, and only those run their regular
expression. Rules without any such token are tried on every URL (there should
be few: at most ``MAX_UNINDEXED``).

Verdict: the longest fitting host rule decides (equal lengths: allow, then the
smaller rule); where none fits, a URL is blocked if a block pattern fits and no
``except`` pattern does, else allowed.

Everything is DataFrame expressions. Equal URLs are judged once. The index is
joined by token; it is broadcast up to ``MAX_BROADCAST`` rules, else the join
is left to Spark.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule, and the verdict of the patterns (allow for null); rows that repeat a
page_id each get a row; an empty table gives an empty result; extra columns
are ignored; urls of any length are judged whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import ascii_lower, cut_lineage

MAX_BROADCAST = 20_000      # rules; a row has at most a few hundred bytes
MAX_UNINDEXED = 64

#: The contract's host rules (fixed values), in its order.
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Patterns for what no host rule decides.
PATTERNS = (
    ("block", "^ads^"), ("block", "^adserver^"), ("block", "^banner^"), ("block", "^banners^"),
    ("block", "^popup^"), ("block", "^doubleclick^"), ("block", "^tracker^"), ("block", "^login^"),
    ("block", "^signup^"), ("block", "^cart^"), ("block", "^checkout^"), ("block", "^casino^"),
    ("block", "^porn^"), ("block", "^xxx^"), ("block", "^wp-admin^"), ("block", "^cgi-bin^"),
    ("block", "*.exe^"), ("block", "*.zip^"),
    ("except", "^login^help^"), ("except", "^ads^policy^"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens_of(pattern: str) -> list[str]:
    """Runs of a-z0-9 (lower-cased) that the pattern delimits on both sides."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9]+", pattern):
        left, right = pattern[:m.start()][-1:], pattern[m.end():][:1]
        if left not in ("", "*") and right not in ("", "*"):
            out.append(m[0].lower())
    return list(dict.fromkeys(out))


def _rule_rows(host_rules, patterns) -> list[tuple]:
    """(id, kind, rule, length, regex, tokens). Host rules match ``host||path``
    (a host has no slash); patterns match the URL."""
    rows = []
    for verdict, host, path in host_rules:
        rule = host + path
        rows.append((len(rows), verdict, rule, len(rule), r"^([^/]*\.)?" + re.escape(rule), _tokens_of("." + rule)))
    for kind, p in patterns:
        regex = "".join(".*" if c == "*" else r"(?:[^A-Za-z0-9_.%-]|^|$)" if c == "^" else re.escape(c) for c in p)
        rows.append((len(rows), "pattern-" + kind, None, 0, "(?si)" + regex, _tokens_of(p.replace("^", "/"))))
    return rows


def _url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(url), "[^a-z0-9]+"))


def rule_index(spark: SparkSession, urls: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """``(token, id, kind, rule, length, regex)``: each rule under the one of
    its tokens that is rarest in ``urls(url)`` (ties: the smaller token);
    null token for rules without one."""
    rows = _rule_rows(host_rules, patterns)
    rules = spark.createDataFrame(
        rows, "id int, kind string, rule string, length int, regex string, tokens array<string>")
    if sum(not r[5] for r in rows) > MAX_UNINDEXED:
        raise ValueError("too many rules without a literal token")
    words = rules.select("id", F.explode("tokens").alias("token"))
    wanted = _small(words.select("token").distinct(), len(rows))
    seen = (urls.select(F.explode(_url_tokens(F.col("url"))).alias("token"))
            .join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    best = (words.join(seen, "token", "left").groupBy("id")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("b")))
    return rules.drop("tokens").join(best.select("id", F.col("b.token").alias("token")), "id", "left")


def _small(rules: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rules) if n <= MAX_BROADCAST else rules


def judge(pages: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages(page_id, url)``."""
    spark, n = pages.sparkSession, len(host_rules) + len(patterns)
    rows = pages.select("page_id", "url")
    urls = cut_lineage(rows.where(F.col("url").isNotNull()).select("url").distinct())
    index = cut_lineage(rule_index(spark, urls, host_rules, patterns))
    keyed = urls.select("url", F.explode(_url_tokens(F.col("url"))).alias("token"))
    fetched = keyed.join(_small(index.where(F.col("token").isNotNull()), n), "token")
    loose = index.where(F.col("token").isNull()).collect()      # at most MAX_UNINDEXED rows
    if loose:
        rule = F.explode(F.array(*[F.struct(*[F.lit(r[c]).cast(index.schema[c].dataType).alias(c) for c in index.columns])
                                   for r in loose])).alias("r")
        fetched = fetched.unionByName(urls.select("url", rule).select("url", "r.*").select(*fetched.columns))
    subject = F.when(F.col("kind").startswith("pattern-"), F.col("url")).otherwise(
        F.concat(host_of(F.col("url")), path_of(F.col("url"))))
    hits = fetched.where(F.rlike(subject, F.col("regex")))
    is_host = F.col("rule").isNotNull()
    decided = hits.groupBy("url").agg(
        F.min(F.when(is_host, F.struct((-F.col("length")).alias("l"), F.col("kind").alias("verdict"), "rule"))).alias("best"),
        F.max(F.col("kind") == "pattern-block").alias("blocked"),
        F.max(F.col("kind") == "pattern-except").alias("excepted"))
    method = F.when(F.col("blocked") & ~F.col("excepted"), "block").otherwise("allow")
    decided = cut_lineage(decided.select(
        F.col("url").alias("judged"), F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), method).alias("verdict")))
    return (rows.join(decided, F.col("url") == F.col("judged"), "left")
            .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                    F.coalesce("verdict", F.lit("allow")).alias("verdict")))
