"""Queries over as-of, interval and matching joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import seconds
from ..operators import aggregates as A
from ..operators import feed as E
from ..operators import matching as M
from ..operators import runs as R
from ..operators import temporal_joins as J
from . import segments as G
from .inputs import DAY, EVENTS, HOUR, RUNS, events, read, typed

KEY, ORDER = ["user_id"], ["t", "event_id"]
OFFSETS = (-7200.0, -3600.0, 0.0, 3600.0, 7200.0)


def _runs(spark, sf_dir, kind=None):
    out = R.run_lengths(events(spark, sf_dir), KEY, ORDER, ["event_type"], "t")
    return out.where(F.col("event_type") == kind) if kind else out


def live_gate(spark, sf_dir):
    """Events inside the trimmed long 'view' runs of their user."""
    spans = R.gate(_runs(spark, sf_dir).withColumnRenamed("event_type", "state"), "view", least=2 * HOUR, trim=HOUR)
    return J.interval_join(events(spark, sf_dir), spans.select("user_id", "start_t", "end_t"), KEY, "t", how="left_semi", width=DAY).select("event_id", "user_id", "t")


def asof_value(spark, sf_dir):
    """Each purchase with the click run that covers it an hour earlier."""
    p = typed(spark, sf_dir, "purchase").select("event_id", "user_id", (F.col("t") - HOUR).alias("t"))
    runs = _runs(spark, sf_dir).select("user_id", "start_t", "end_t", "event_type", "samples")
    return J.value_at(p, runs, KEY, "t", ["event_type", "samples"]).select("event_id", "event_type", "samples")


def asof_backward(spark, sf_dir):
    """Each order with its customer's latest earlier order."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", seconds(F.col("o_orderdate")).alias("t"))
    past = o.select("o_custkey", F.col("t").alias("prev_t"), F.col("o_orderkey").alias("prev_key"))
    return J.asof(o, past, ["o_custkey"], "t", "prev_t", ["prev_t", "prev_key"], strict=True, tie=["prev_key"])


def asof_forward(spark, sf_dir):
    """Each error with its user's next purchase."""
    e = typed(spark, sf_dir, "error").select("event_id", "user_id", "t")
    p = typed(spark, sf_dir, "purchase").select("user_id", F.col("t").alias("next_t"), F.col("event_id").alias("next_id"))
    return J.asof(e, p, KEY, "t", "next_t", ["next_t", "next_id"], forward=True, strict=True, tie=["next_id"])


def asof_slack_first(spark, sf_dir):
    """Each signup with the run begun first of those within an hour of it."""
    s = typed(spark, sf_dir, "signup").select("event_id", "user_id", "t")
    return J.first_covering(s, _runs(spark, sf_dir), KEY, ["event_id"], "t", ["event_type", "run"], slack=HOUR, width=6 * HOUR).select("event_id", "event_type", "run")


def pair_series(spark, sf_dir):
    """Runs of the pair (event type, half-day bucket of value) of each user."""
    e = events(spark, sf_dir).withColumn("level", F.floor(F.col("value") / 50).cast("int"))
    left = R.run_lengths(e, KEY, ORDER, ["event_type"], "t").withColumnRenamed("event_type", "v")
    right = R.run_lengths(e, KEY, ORDER, ["level"], "t").withColumn("v", F.col("level").cast("string"))
    return J.pair_series(left, right, KEY, "v")


def interval_overlap_semi(spark, sf_dir):
    """View runs during which some other user's click run was open."""
    r = _runs(spark, sf_dir).select("user_id", "event_type", "start_t", "end_t")
    a, b = (r.where(F.col("event_type") == k) for k in ("view", "click"))
    return J.overlapping_others(a, b, "user_id", HOUR).select("user_id", "start_t", "end_t")


def survived_anti(spark, sf_dir):
    """Errors without a purchase by the user within a day."""
    e = typed(spark, sf_dir, "error").select("event_id", "user_id", "t")
    return J.near(e, typed(spark, sf_dir, "purchase"), KEY, "t", "t", 0.0, DAY, "left_anti")


def unwitnessed_anti(spark, sf_dir):
    """Purchases without a view from a day before to two days after."""
    p = typed(spark, sf_dir, "purchase").select("event_id", "user_id", "t")
    return J.near(p, typed(spark, sf_dir, "view"), KEY, "t", "t", DAY, 2 * DAY, "left_anti")


def expand_instants(spark, sf_dir):
    """Hourly instants inside runs."""
    return J.instants(_runs(spark, sf_dir), HOUR).select("user_id", "run", "t")


def agreement_rate(spark, sf_dir):
    """How often a user's type of event an hour before a signup is that of a day
    before it."""
    s = typed(spark, sf_dir, "signup").select("event_id", "user_id", (F.col("t") - HOUR).alias("t1"), (F.col("t") - DAY).alias("t2"))
    e = events(spark, sf_dir)
    a = e.select("user_id", F.col("t").alias("ta"), F.col("event_type").alias("a"), F.col("event_id").alias("ia"))
    b = e.select("user_id", F.col("t").alias("tb"), F.col("event_type").alias("b"), F.col("event_id").alias("ib"))
    both = J.asof(s, a, KEY, "t1", "ta", ["a", "ia"], tie=["ia"]).drop("ia")
    both = J.asof(both, b, KEY, "t2", "tb", ["b", "ib"], tie=["ib"])
    return A.agreement(both, "a", "b", KEY)


def greedy_match(spark, sf_dir):
    """Errors matched one-to-one to purchases of the user within two days."""
    e, p = (typed(spark, sf_dir, k).select("user_id", "t") for k in ("error", "purchase"))
    return M.match_events(e, p, KEY, 2 * DAY)


def offset_sweep(spark, sf_dir):
    """Candidate matches at each offset."""
    e, p = (typed(spark, sf_dir, k).select("user_id", "t") for k in ("error", "purchase"))
    return M.candidate_counts(e, p, KEY, OFFSETS, 6 * HOUR)


def greedy_sweep(spark, sf_dir):
    """One-to-one matches at each offset."""
    e, p = (typed(spark, sf_dir, k).select("user_id", "t") for k in ("error", "purchase"))
    return M.sweep(e, p, KEY, OFFSETS, 6 * HOUR)


def step_match(spark, sf_dir):
    """Errors and purchases of a user within two days, matched one-to-one, with
    those on either side that are left over."""
    e, p = (typed(spark, sf_dir, k).select("user_id", "t") for k in ("error", "purchase"))
    return M.match_both(e, p, KEY, 2 * DAY)


def neighbour_vote(spark, sf_dir):
    """The event type that a user's hour and its neighbours of the same k modulo
    5 prefer."""
    e = events(spark, sf_dir).withColumn("h", F.floor(F.col("t") / HOUR).cast("double"))
    rows = e.groupBy("user_id", F.col("h").alias("t"), (F.col("event_id") % 3).alias("slot")).agg((F.min("k") % 5).alias("signature"))
    votes = e.select("user_id", F.col("h").alias("t"), (F.col("event_id") % 3).alias("slot"), F.lit("type").alias("role"), F.col("event_type").alias("player"), F.lit(1.0).alias("weight"))
    return E.neighbour_votes(rows.where(F.col("signature").isNotNull()), votes, KEY).drop("role")


def first_in_day(spark, sf_dir):
    """The first event of each user and day."""
    e = events(spark, sf_dir).select("user_id", F.floor(F.col("t") / DAY).cast("bigint").alias("day"), "t", F.col("event_id").alias("attacker"), F.col("event_type").alias("victim"))
    return E.first_of(e, ["user_id", "day"])


def kill_checks(spark, sf_dir):
    """Whether a side's kills exceed the other's deaths, by day."""
    e = events(spark, sf_dir).select(F.lit("v").alias("vod"), F.floor(F.col("t") / DAY).cast("int").alias("map"), (F.col("user_id") % 8 + 1).cast("int").alias("slot"), F.coalesce("k", F.lit(0)).alias("k"), "event_type")
    box = e.groupBy("vod", "map", "slot").agg(F.sum("k").alias("kills"), (F.count(F.lit(1)) * 45).alias("deaths"))
    return G.kill_checks(box).select("map", "name", "passed", "others")


def unpivot_roles(spark, sf_dir):
    """Ship instants of line items and order instants of orders, as one list."""
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.lit("shipped").alias("role"), seconds(F.col("l_shipdate")).alias("t"))
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.lit("ordered").alias("role"), seconds(F.col("o_orderdate")).alias("t"))
    return li.unionByName(o).groupBy("key", "role").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


QUERIES = {f.__name__: f for f in (live_gate, asof_value, asof_backward, asof_forward, asof_slack_first, pair_series, interval_overlap_semi, survived_anti, unwitnessed_anti, expand_instants, agreement_rate, greedy_match, offset_sweep, greedy_sweep, step_match, neighbour_vote, first_in_day, kill_checks, unpivot_roles)}

_OFFSETS = ", ".join(f"({x})" for x in OFFSETS)


def _greedy(a: str, b: str, key: str, window: float, order: str) -> str:
    """CTEs that take candidate pairs one by one: z holds key, i, j. ``a`` and
    ``b`` select key and t."""
    return f"""a AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY t) AS i FROM ({a})), b AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY t) AS j FROM ({b})),
c AS (SELECT ({key}) AS key, i, j, row_number() OVER (PARTITION BY {key} ORDER BY abs(b.t - a.t), {order} i, j) AS k FROM a JOIN b USING ({key}) WHERE abs(b.t - a.t) <= {window}),
f AS (SELECT DISTINCT key, 0::BIGINT AS k, []::BIGINT[] AS ua, []::BIGINT[] AS ub FROM c
  UNION ALL SELECT f.key, c.k, CASE WHEN list_contains(ua, i) OR list_contains(ub, j) THEN ua ELSE list_append(ua, i) END, CASE WHEN list_contains(ua, i) OR list_contains(ub, j) THEN ub ELSE list_append(ub, j) END
  FROM f JOIN c ON c.key = f.key AND c.k = f.k + 1),
y AS (SELECT key, arg_max(ua, k) AS ua, arg_max(ub, k) AS ub FROM f GROUP BY key), z AS (SELECT key, unnest(ua) AS i, unnest(ub) AS j FROM y)"""


_ERRORS, _BUYS = "SELECT user_id, t FROM e WHERE event_type = 'error'", "SELECT user_id, t FROM e WHERE event_type = 'purchase'"
_SHIFTED = "SELECT x AS off, user_id, t + x AS t FROM e, o WHERE event_type = 'error'"
ORACLE_SQL = {
    "greedy_match": f"""WITH RECURSIVE {EVENTS}, {_greedy(_ERRORS, _BUYS.replace("SELECT", "SELECT DISTINCT"), "user_id", 2 * DAY, "")}
SELECT a.user_id, a.t, b.t AS matched_t, b.t - a.t AS delta FROM a LEFT JOIN z ON z.key = a.user_id AND z.i = a.i LEFT JOIN b ON b.user_id = a.user_id AND b.j = z.j""",
    "greedy_sweep": f"""WITH RECURSIVE {EVENTS}, o(x) AS (SELECT x::DOUBLE FROM (VALUES {_OFFSETS}) v(x)), {_greedy(_SHIFTED, "SELECT DISTINCT x AS off, user_id, t FROM e, o WHERE event_type = 'purchase'", "off, user_id", 6 * HOUR, "")}
SELECT a.off AS "offset", count(*)::BIGINT AS falls, count(z.j)::BIGINT AS matched FROM a LEFT JOIN z ON z.key = (a.off, a.user_id) AND z.i = a.i GROUP BY a.off""",
    "step_match": f"""WITH RECURSIVE {EVENTS}, {_greedy(_ERRORS, _BUYS, "user_id", 2 * DAY, "b.t - a.t,")}
SELECT a.user_id, a.t, b.t AS event_t, b.t - a.t AS delta FROM a LEFT JOIN z ON z.key = a.user_id AND z.i = a.i LEFT JOIN b ON b.user_id = a.user_id AND b.j = z.j
UNION ALL SELECT b.user_id, NULL, b.t, NULL FROM b WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.key = b.user_id AND z.j = b.j)""",
    "neighbour_vote": f"""WITH {EVENTS}, x AS (SELECT user_id, floor(t / 3600)::DOUBLE AS t, event_id % 3 AS slot, k, event_type FROM e),
r AS (SELECT user_id, t, slot, min(k) % 5 AS sig FROM x GROUP BY 1, 2, 3 HAVING min(k) IS NOT NULL), v AS (SELECT user_id, t, slot, event_type AS player, count(*)::DOUBLE AS n FROM x GROUP BY 1, 2, 3, 4),
l AS (SELECT user_id, t, slot, t AS at, slot AS s, 1.0::DOUBLE AS w FROM r UNION ALL
  SELECT a.user_id, a.t, a.slot, b.t, b.slot, 0.5 FROM r a JOIN r b ON a.user_id = b.user_id AND a.sig = b.sig AND abs(b.t - a.t) BETWEEN 1 AND 3 AND (CASE WHEN b.t < a.t THEN b.slot <= a.slot ELSE b.slot >= a.slot END)),
p AS (SELECT l.user_id, l.t, l.slot, player, sum(w * n) AS s FROM l JOIN v ON v.user_id = l.user_id AND v.t = l.at AND v.slot = l.s GROUP BY 1, 2, 3, 4),
q AS (SELECT *, row_number() OVER (PARTITION BY user_id, t, slot ORDER BY s DESC, player) AS rn, sum(s) OVER (PARTITION BY user_id, t, slot) AS total FROM p)
SELECT user_id, t, slot, player AS label, round(s / total, 3) AS agreement FROM q WHERE rn = 1""",
    "first_in_day": f"""WITH {EVENTS}, q AS (SELECT *, floor(t / 86400)::BIGINT AS day, row_number() OVER (PARTITION BY user_id, floor(t / 86400) ORDER BY t, event_id) AS rn FROM e)
SELECT user_id, day, t, event_id AS attacker, event_type AS victim FROM q WHERE rn = 1""",
    "kill_checks": f"""WITH {EVENTS}, s AS (SELECT floor(t / 86400)::INT AS map, user_id % 8 + 1 AS slot, sum(coalesce(k, 0))::BIGINT AS kills, count(*) * 45 AS deaths FROM e GROUP BY 1, 2),
m AS (SELECT map, count(*) AS n, sum(kills) FILTER (WHERE slot <= 4)::BIGINT AS lk, sum(deaths) FILTER (WHERE slot <= 4)::BIGINT AS ld, sum(kills) FILTER (WHERE slot > 4)::BIGINT AS rk, sum(deaths) FILTER (WHERE slot > 4)::BIGINT AS rd FROM s GROUP BY map)
SELECT map, 'left kills' AS name, n = 8 AND lk <= rd AS passed, rd - lk AS others FROM m UNION ALL SELECT map, 'right kills', n = 8 AND rk <= ld, ld - rk FROM m""",
    "live_gate": f"""WITH {RUNS}, s AS (SELECT user_id, start_t + 3600 AS a, end_t - 3600 AS z FROM r WHERE event_type = 'view' AND end_t - start_t > 7200)
SELECT event_id, user_id, t FROM e WHERE EXISTS (SELECT 1 FROM s WHERE s.user_id = e.user_id AND e.t >= s.a AND e.t <= s.z)""",
    "asof_value": f"""WITH {RUNS} SELECT e.event_id, r.event_type, r.samples FROM e LEFT JOIN r
  ON r.user_id = e.user_id AND e.t - 3600 >= r.start_t AND e.t - 3600 <= r.end_t WHERE e.event_type = 'purchase'""",
    "asof_backward": """WITH o AS (SELECT o_orderkey, o_custkey, epoch_us(o_orderdate)::DOUBLE / 1e6 AS t FROM orders), j AS (
  SELECT a.*, b.t AS prev_t, b.o_orderkey AS prev_key, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.t DESC NULLS LAST, b.o_orderkey DESC) AS rn
  FROM o a LEFT JOIN o b ON a.o_custkey = b.o_custkey AND b.t < a.t)
SELECT o_orderkey, o_custkey, t, prev_t, prev_key FROM j WHERE rn = 1""",
    "asof_forward": f"""WITH {EVENTS}, j AS (
  SELECT a.event_id, a.user_id, a.t, b.t AS next_t, b.event_id AS next_id, row_number() OVER (PARTITION BY a.event_id ORDER BY b.t NULLS LAST, b.event_id) AS rn
  FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND b.t > a.t AND b.event_type = 'purchase' WHERE a.event_type = 'error')
SELECT event_id, user_id, t, next_t, next_id FROM j WHERE rn = 1""",
    "asof_slack_first": f"""WITH {RUNS}, j AS (
  SELECT e.event_id, r.event_type, r.run, row_number() OVER (PARTITION BY e.event_id ORDER BY r.start_t NULLS LAST) AS rn
  FROM e LEFT JOIN r ON r.user_id = e.user_id AND e.t >= r.start_t - 3600 AND e.t <= r.end_t + 3600 WHERE e.event_type = 'signup')
SELECT event_id, event_type, run FROM j WHERE rn = 1""",
    "pair_series": f"""WITH {RUNS}, lv AS (SELECT *, floor(value / 50)::INT AS level FROM e), b3 AS (
  SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS brk3 FROM lv WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), n3 AS (SELECT *, sum(brk3) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run3 FROM b3
), rr AS (SELECT user_id, min(level)::VARCHAR AS v, min(t) AS start_t, max(t) AS end_t FROM n3 GROUP BY user_id, run3
), st AS (SELECT user_id, start_t AS t FROM r UNION SELECT user_id, start_t FROM rr
), j AS (
  SELECT st.user_id, st.t, r.event_type AS left_value, rr.v AS right_value, least(r.end_t, rr.end_t) AS e
  FROM st JOIN r ON r.user_id = st.user_id AND st.t BETWEEN r.start_t AND r.end_t JOIN rr ON rr.user_id = st.user_id AND st.t BETWEEN rr.start_t AND rr.end_t
  WHERE rr.v IS NOT NULL
), b4 AS (
  SELECT *, CASE WHEN left_value IS DISTINCT FROM lag(left_value) OVER w OR right_value IS DISTINCT FROM lag(right_value) OVER w THEN 1 ELSE 0 END AS brk4 FROM j WINDOW w AS (PARTITION BY user_id ORDER BY t)
), n4 AS (SELECT *, sum(brk4) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run4 FROM b4)
SELECT user_id, min(t) AS start_t, max(e) AS end_t, min(left_value) AS left_value, min(right_value) AS right_value FROM n4 GROUP BY user_id, run4""",
    "interval_overlap_semi": f"""WITH {RUNS} SELECT user_id, start_t, end_t FROM r a WHERE event_type = 'view' AND EXISTS (
  SELECT 1 FROM r b WHERE b.event_type = 'click' AND b.user_id <> a.user_id AND a.start_t <= b.end_t AND b.start_t <= a.end_t)""",
    "survived_anti": f"""WITH {EVENTS} SELECT event_id, user_id, t FROM e a WHERE event_type = 'error' AND NOT EXISTS (
  SELECT 1 FROM e b WHERE b.event_type = 'purchase' AND b.user_id = a.user_id AND b.t - 86400 <= a.t AND a.t <= b.t)""",
    "unwitnessed_anti": f"""WITH {EVENTS} SELECT event_id, user_id, t FROM e a WHERE event_type = 'purchase' AND NOT EXISTS (
  SELECT 1 FROM e b WHERE b.event_type = 'view' AND b.user_id = a.user_id AND b.t - 172800 <= a.t AND a.t <= b.t + 86400)""",
    "expand_instants": f"""WITH {RUNS}, x AS (SELECT user_id, run, start_t, unnest(range(0, floor((end_t - start_t) / 3600)::BIGINT + 1)) AS i FROM r)
SELECT user_id, run, start_t + i * 3600.0::DOUBLE AS t FROM x""",
    "agreement_rate": f"""WITH {EVENTS}, ja AS (
  SELECT s.event_id, s.user_id, s.t, a.event_type AS a, row_number() OVER (PARTITION BY s.event_id ORDER BY a.t DESC NULLS LAST, a.event_id DESC) AS rn
  FROM e s LEFT JOIN e a ON a.user_id = s.user_id AND a.t <= s.t - 3600 WHERE s.event_type = 'signup'
), jb AS (
  SELECT ja.event_id, ja.user_id, ja.a, b.event_type AS b, row_number() OVER (PARTITION BY ja.event_id ORDER BY b.t DESC NULLS LAST, b.event_id DESC) AS rn
  FROM ja LEFT JOIN e b ON b.user_id = ja.user_id AND b.t <= ja.t - 86400 WHERE ja.rn = 1)
SELECT user_id, count(*)::BIGINT AS compared, count_if(a = b)::BIGINT AS equal FROM jb WHERE rn = 1 AND a IS NOT NULL AND b IS NOT NULL GROUP BY user_id""",
    "offset_sweep": f"""WITH {EVENTS}, o(x) AS (VALUES {_OFFSETS}), f AS (SELECT x::DOUBLE AS off, user_id, t FROM e, o WHERE event_type = 'error'),
j AS (SELECT f.off, f.user_id, f.t, p.t AS pt FROM f JOIN e p ON p.event_type = 'purchase' AND p.user_id = f.user_id AND p.t >= (f.t + f.off) - 21600 AND p.t <= (f.t + f.off) + 21600),
c AS (SELECT off, count(DISTINCT (user_id, t))::BIGINT AS a, count(*)::BIGINT AS b FROM j GROUP BY off), n AS (SELECT off, count(*)::BIGINT AS falls FROM f GROUP BY off)
SELECT n.off AS "offset", n.falls, coalesce(c.a, 0) AS falls_with_candidate, coalesce(c.b, 0) AS candidates FROM n LEFT JOIN c ON n.off = c.off""",
    "unpivot_roles": """WITH u AS (
  SELECT l_orderkey AS key, 'shipped' AS role, epoch_us(l_shipdate)::DOUBLE / 1e6 AS t FROM lineitem
  UNION ALL SELECT o_orderkey, 'ordered', epoch_us(o_orderdate)::DOUBLE / 1e6 FROM orders)
SELECT key, role, count(*)::BIGINT AS n, min(t) AS first_t, max(t) AS last_t FROM u GROUP BY key, role""",
}
