"""Queries over grouped operators and parsing expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import clock_seconds, numeric_cell, ratio_parts, seconds
from ..operators import aggregates as A
from ..operators import sequences as S
from .inputs import EVENTS, events, read


def weighted_mode(spark, sf_dir):
    """Per supplier, the return flag of most quantity, the first ordered of
    equals."""
    li = read(spark, sf_dir, "lineitem")
    out = A.weighted_mode(li, ["l_suppkey"], "l_returnflag", F.col("l_quantity").cast("bigint"), F.col("l_orderkey"))
    return out.select("l_suppkey", "l_returnflag", F.col("weight").cast("bigint").alias("weight"))


def quorum_reset(spark, sf_dir):
    """Hours (rounded half to even) in which at least three users err."""
    e = events(spark, sf_dir).where(F.col("event_type") == "error").withColumn("hour", F.floor(F.col("t") / 1800) / 2)
    return A.quorum(e, "hour", ["user_id"], 3)


def reconcile_totals(spark, sf_dir):
    """Line items per order against orders' last digit, error and excess."""
    found = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    expected = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") % 8).alias("n"))
    return A.reconcile(found, expected, ["key"], "n")


def reconcile_summary(spark, sf_dir):
    """Total error and excess of the reconciliation."""
    r = reconcile_totals(spark, sf_dir)
    return r.agg(F.sum("found").alias("found"), F.sum("expected").alias("expected"), F.sum("error").alias("error"), F.sum("excess").alias("excess"), F.count_if(F.col("error") > 0).alias("wrong_keys"))


def last_reading(spark, sf_dir):
    """The latest value of each user and event type."""
    e = events(spark, sf_dir)
    return A.last_reading(e, ["user_id", "event_type"], "t", ["t", "event_id", "value"], tie="event_id")


def precision_recall(spark, sf_dir):
    """Labelled quality against a length rule on the documents."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") >= 400, "1").otherwise("0").alias("predicted"))
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("truth"))
    return A.precision_recall(d.join(labels, "doc_id"), "truth", "predicted")


def exact_dup_groups(spark, sf_dir):
    """Groups of documents with one text."""
    return A.equal_groups(read(spark, sf_dir, "documents"), "text", "doc_id")


def clock_parse(spark, sf_dir):
    """Clock texts of several forms, parsed back to seconds."""
    n = F.floor(F.col("value")).cast("bigint")
    text = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.floor(n / 60).cast("string"), F.lit(":"), F.lpad((n % 60).cast("string"), 2, "0")))
        .when(F.col("event_id") % 4 == 1, F.concat(n.cast("string"), F.lit("."), (n % 10).cast("string")))
        .when(F.col("event_id") % 4 == 2, F.concat(n.cast("string"), F.lit(":"), (n % 10).cast("string")))
        .otherwise(F.concat(F.lit("."), n.cast("string")))
    )
    return events(spark, sf_dir).select("event_id", text.alias("clock"), clock_seconds(text).alias("seconds"))


def kd_parse(spark, sf_dir):
    """'a/b' cells, parsed strictly and summed by type."""
    text = F.concat((F.col("k") % 30).cast("string"), F.when(F.col("event_id") % 7 == 0, "-").otherwise("/"), (F.col("event_id") % 25).cast("string"))
    a, b = ratio_parts(text)
    cells = events(spark, sf_dir).select("event_type", a.alias("a"), b.alias("b"))
    return cells.groupBy("event_type").agg(F.sum("a").alias("kills"), F.sum("b").alias("deaths"), F.count_if(F.col("a").isNull()).alias("unread"))


def team_balance(spark, sf_dir):
    """Kills of one side against deaths of the other, per event type."""
    e = events(spark, sf_dir).withColumn("side", F.col("user_id") % 2)
    kills = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("k"))), F.lit(0))
    deaths = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.floor(F.col("value")).cast("bigint"))), F.lit(0))
    out = e.groupBy("event_type").agg(kills(0).alias("k0"), deaths(1).alias("d1"), kills(1).alias("k1"), deaths(0).alias("d0"))
    return out.select("event_type", (F.col("k0") <= F.col("d1")).alias("passed_0"), (F.col("d1") - F.col("k0")).alias("other_0"), (F.col("k1") <= F.col("d0")).alias("passed_1"), (F.col("d0") - F.col("k1")).alias("other_1"))


def wellformed(spark, sf_dir):
    """Words of documents that are numbers in a cell's sense, per language."""
    words = read(spark, sf_dir, "documents").select("lang", F.explode(F.split(F.concat(F.col("text"), F.lit(" 7/3 3:15 12.5% 1/2/3 x9 ")), " ")).alias("w"))
    return words.groupBy("lang").agg(F.count_if(numeric_cell(F.col("w"))).alias("numbers"), F.count(F.lit(1)).alias("words"))


def set_ops(spark, sf_dir):
    """Users with errors and purchases; with errors only; with either."""
    e = events(spark, sf_dir)
    err, buy = (e.where(F.col("event_type") == k).select("user_id").distinct() for k in ("error", "purchase"))
    tag = lambda d, name: d.select(F.lit(name).alias("kind"), "user_id")
    return tag(err.intersect(buy), "both").unionByName(tag(err.exceptAll(buy), "error only")).unionByName(tag(err.union(buy).distinct(), "either"))


def consistent_users(spark, sf_dir):
    """Whether each supplier key maps to one nation in every listing."""
    s = read(spark, sf_dir, "supplier")
    both = s.select("s_suppkey", "s_nationkey").union(s.where(F.col("s_acctbal") < 0).select("s_suppkey", ((F.col("s_nationkey") + 1) % 25).cast("int")))
    return A.consistent_map(both, "s_suppkey", "s_nationkey")


def witness_join(spark, sf_dir):
    """Orders that have both a returned and an accepted item: checks as rows."""
    li = read(spark, sf_dir, "lineitem")
    flags = li.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("r"), F.bool_or(F.col("l_returnflag") == "A").alias("a"), F.countDistinct("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("items"))
    checks = F.explode(
        F.array(
            F.struct(F.lit("both flags").alias("name"), (F.col("r") & F.col("a")).alias("passed")),
            F.struct(F.lit("suppliers differ").alias("name"), (F.col("suppliers") == F.col("items")).alias("passed")),
        )
    ).alias("c")
    return flags.select("l_orderkey", checks).groupBy(F.col("c.name").alias("name")).agg(F.count_if("c.passed").alias("passed"), F.count_if(~F.col("c.passed")).alias("failed"))


def event_days(spark, sf_dir):
    """The sampling preset implied by the events' own steps."""
    return S.infer_preset(events(spark, sf_dir), "t").select("preset", F.round("min_step", 6).alias("min_step"))


QUERIES = {
    f.__name__: f
    for f in (weighted_mode, quorum_reset, reconcile_totals, reconcile_summary, last_reading, precision_recall, exact_dup_groups, clock_parse, kd_parse, team_balance, wellformed, set_ops, consistent_users, witness_join, event_days)
}

_RECONCILE = """f AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1), x AS (SELECT o_orderkey AS key, o_custkey % 8 AS n FROM orders),
q AS (SELECT key, coalesce(f.n, 0)::BIGINT AS found, coalesce(x.n, 0)::BIGINT AS expected FROM f FULL JOIN x USING (key))"""
ORACLE_SQL = {
    "weighted_mode": """WITH v AS (SELECT l_suppkey, l_returnflag, sum(l_quantity::BIGINT)::BIGINT AS weight, min(l_orderkey) AS seen FROM lineitem GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY weight DESC, seen) AS rn FROM v)
SELECT l_suppkey, l_returnflag, weight FROM k WHERE rn = 1""",
    "quorum_reset": f"""WITH {EVENTS}, h AS (SELECT DISTINCT round_even(floor(t / 1800) / 2, 0)::BIGINT AS instant, user_id FROM e WHERE event_type = 'error')
SELECT instant, count(*)::BIGINT AS members FROM h GROUP BY instant HAVING count(*) >= 3""",
    "reconcile_totals": f"WITH {_RECONCILE} SELECT key, found, expected, abs(found - expected) AS error, greatest(found - expected, 0) AS excess FROM q",
    "reconcile_summary": f"""WITH {_RECONCILE} SELECT sum(found)::BIGINT AS found, sum(expected)::BIGINT AS expected, sum(abs(found - expected))::BIGINT AS error,
  sum(greatest(found - expected, 0))::BIGINT AS excess, count_if(found <> expected)::BIGINT AS wrong_keys FROM q""",
    "last_reading": f"""WITH {EVENTS}, k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t DESC, event_id DESC) AS rn FROM e)
SELECT user_id, event_type, t, event_id, value FROM k WHERE rn = 1""",
    "precision_recall": """WITH j AS (SELECT quality::VARCHAR AS truth, CASE WHEN n_chars >= 400 THEN '1' ELSE '0' END AS predicted FROM documents JOIN labels USING (doc_id)),
c AS (SELECT truth AS class FROM j UNION SELECT predicted FROM j),
n AS (SELECT class, count_if(truth = class AND predicted = class)::BIGINT AS tp, count_if(truth <> class AND predicted = class)::BIGINT AS fp,
        count_if(truth = class AND predicted <> class)::BIGINT AS fn FROM c, j GROUP BY class)
SELECT *, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall FROM n""",
    "exact_dup_groups": "SELECT min(doc_id) AS first, count(*)::BIGINT AS members FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) >= 2",
    "clock_parse": f"""WITH {EVENTS}, c AS (SELECT event_id, floor(value)::BIGINT AS n FROM e), x AS (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN (n // 60)::VARCHAR || ':' || lpad((n % 60)::VARCHAR, 2, '0') WHEN 1 THEN n::VARCHAR || '.' || (n % 10)::VARCHAR
    WHEN 2 THEN n::VARCHAR || ':' || (n % 10)::VARCHAR ELSE '.' || n::VARCHAR END AS clock FROM c)
SELECT event_id, clock, CASE WHEN regexp_full_match(clock, '[0-9]+:[0-9]{{2}}') THEN split_part(clock, ':', 1)::DOUBLE * 60 + split_part(clock, ':', 2)::DOUBLE
  WHEN regexp_full_match(clock, '[0-9]+\\.[0-9]') THEN split_part(clock, '.', 1)::DOUBLE + split_part(clock, '.', 2)::DOUBLE / 10 END AS seconds FROM x""",
    "kd_parse": f"""WITH {EVENTS}, c AS (SELECT event_type, (k % 30)::VARCHAR || CASE WHEN event_id % 7 = 0 THEN '-' ELSE '/' END || (event_id % 25)::VARCHAR AS x FROM e),
p AS (SELECT event_type, CASE WHEN regexp_full_match(x, '[0-9]+/[0-9]+') THEN split_part(x, '/', 1)::BIGINT END AS a,
        CASE WHEN regexp_full_match(x, '[0-9]+/[0-9]+') THEN split_part(x, '/', 2)::BIGINT END AS b FROM c)
SELECT event_type, sum(a)::BIGINT AS kills, sum(b)::BIGINT AS deaths, count_if(a IS NULL)::BIGINT AS unread FROM p GROUP BY event_type""",
    "team_balance": f"""WITH {EVENTS}, s AS (SELECT event_type, coalesce(sum(k) FILTER (WHERE user_id % 2 = 0), 0)::BIGINT AS k0, coalesce(sum(floor(value)::BIGINT) FILTER (WHERE user_id % 2 = 1), 0)::BIGINT AS d1,
  coalesce(sum(k) FILTER (WHERE user_id % 2 = 1), 0)::BIGINT AS k1, coalesce(sum(floor(value)::BIGINT) FILTER (WHERE user_id % 2 = 0), 0)::BIGINT AS d0 FROM e GROUP BY event_type)
SELECT event_type, k0 <= d1 AS passed_0, d1 - k0 AS other_0, k1 <= d0 AS passed_1, d0 - k1 AS other_1 FROM s""",
    "wellformed": """WITH w AS (SELECT lang, unnest(string_split(text || ' 7/3 3:15 12.5% 1/2/3 x9 ', ' ')) AS w FROM documents)
SELECT lang, count_if(regexp_full_match(w, '[0-9]+/?[0-9]*|[0-9]*/?[0-9]+|[0-9]+:?[0-9]*|[0-9]*:?[0-9]+|[0-9]+\\.?[0-9]*%*|[0-9]*\\.?[0-9]+%*'))::BIGINT AS numbers, count(*)::BIGINT AS words FROM w GROUP BY lang""",
    "set_ops": f"""WITH {EVENTS}, a AS (SELECT DISTINCT user_id FROM e WHERE event_type = 'error'), b AS (SELECT DISTINCT user_id FROM e WHERE event_type = 'purchase')
SELECT 'both' AS kind, user_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'error only', user_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'either', user_id FROM (SELECT * FROM a UNION SELECT * FROM b)""",
    "consistent_users": """WITH u AS (SELECT s_suppkey, s_nationkey FROM supplier UNION ALL SELECT s_suppkey, ((s_nationkey + 1) % 25)::INT FROM supplier WHERE s_acctbal < 0)
SELECT s_suppkey, min(s_nationkey) AS s_nationkey, min(s_nationkey) = max(s_nationkey) AS consistent FROM u GROUP BY s_suppkey""",
    "witness_join": """WITH f AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AND bool_or(l_returnflag = 'A') AS x, count(DISTINCT l_suppkey) = count(*) AS y FROM lineitem GROUP BY 1)
SELECT 'both flags' AS name, count_if(x)::BIGINT AS passed, count_if(NOT x)::BIGINT AS failed FROM f UNION ALL SELECT 'suppliers differ', count_if(y)::BIGINT, count_if(NOT y)::BIGINT FROM f""",
    "event_days": f"""WITH {EVENTS}, d AS (SELECT DISTINCT t FROM e), g AS (SELECT t - lag(t) OVER (ORDER BY t) AS s FROM d)
SELECT CASE WHEN (SELECT count(*) FROM d) < 3 OR min(s) > 0.5 THEN 'sparse' ELSE 'dense' END AS preset, round(min(s), 6) AS min_step FROM g""",
}
