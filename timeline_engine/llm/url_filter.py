"""URL allow and block rules by host suffix and path prefix (DataFrame
functions only).

Each distinct URL is expanded into expressions: a suffix of its host, followed
by a prefix of its path, for every pair of a number of labels and a length of
path that some rule has (no other expression could meet a rule, so a host of
many labels costs no more than a short one). An expression meets the rules in an equi-join on the first four
bytes of its SHA-256 digest; the full digests then confirm the match. Of the
rules confirmed, the longest decides.

Only URLs are shuffled, each distinct one once. Rules are broadcast when their
counted number is at most ``BROADCAST_RULES``; larger lists take a shuffle join
that adaptive execution can split. The pairs (labels, length of path) of the
rules are the only thing the driver reads. Pages without a URL are spread over
all partitions of the join that hands the verdicts back.

Nulls: a null URL or one without ``://`` has an empty host and path, fits no
rule and gets the default verdict. Repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, own, table

BROADCAST_RULES = 100_000
#: (verdict, host, path without its first slash)
RULES = (
    ("block", "com", "en/"),
    ("allow", "example.com", "en/7"),
    ("allow", "net", "de/"),
    ("block", "example.net", "de/8"),
    ("block", "org", "es/"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.char_length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict added (replacing columns of
    these names)."""
    names = ("host", "path", "rule", "verdict")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    n_labels = lambda host: F.char_length(host) - F.char_length(F.replace(host, F.lit("."), F.lit(""))) + 1
    rule = F.concat(F.col("host"), F.lit("/"), F.col("path"))
    r = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").select(
        rule.alias("rule"), "verdict", n_labels(F.col("host")).alias("labels"), (F.char_length("path") + 1).alias("n"), digest(rule).alias("rule_digest")
    )
    # Of equal rules with two verdicts, block holds.
    r = r.groupBy("rule", "labels", "n", "rule_digest").agg(F.max("verdict").alias("verdict")).withColumn("short", F.substring("rule_digest", 1, 8))
    shapes = sorted((x[0], x[1]) for x in r.select("labels", "n").distinct().collect())
    host, path = split_url(F.col("url"))
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct().select("url", host.alias("host"), path.alias("path"))
    urls = urls.where(F.col("host") != "").withColumn("labels", n_labels(F.col("host")))
    fits = lambda k, n: (F.col("labels") >= k) & (F.char_length("path") >= n)
    made = [F.when(fits(k, n), F.concat(F.substring_index("host", ".", -k), F.substring("path", 1, n))) for k, n in shapes]
    expressions = (
        urls.select("url", F.explode(F.array_compact(F.array(*made).cast("array<string>"))).alias("expression"))
        .withColumn("digest", digest(F.col("expression")))
        .withColumn("short", F.substring("digest", 1, 8))
    )
    few = r.count() <= BROADCAST_RULES
    met = expressions.join(F.broadcast(r) if few else r, "short").where(F.col("digest") == F.col("rule_digest"))
    best = met.groupBy("url").agg(F.max(F.struct(F.char_length("rule").alias("length"), "rule", "verdict")).alias("best")).alias("b")
    p = pages.alias("p")
    url = F.col("p.url")
    spread = F.when(url.isNull(), F.xxhash64(*own(pages, at="p"))).otherwise(F.lit(0))
    out = p.join(best, (url == F.col("b.url")) & (spread == F.lit(0).cast("long") * F.char_length("b.url")), "left")
    host, path = split_url(url)
    verdict = F.coalesce(F.col("b.best.verdict"), F.lit(default)).alias("verdict")
    return out.select(*own(pages, *names, at="p"), host.alias("host"), path.alias("path"), F.col("b.best.rule").alias("rule"), verdict)


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Per page: host, path, deciding rule, verdict."""
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH rules(verdict, host, path) AS (VALUES
  ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
  ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), m AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS rn
  FROM s LEFT JOIN rules r ON ('.' || s.host) LIKE ('%.' || r.host) AND starts_with(s.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE rn = 1
"""
