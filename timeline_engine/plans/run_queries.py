"""Queries over runs and sessions of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import screen_state
from ..operators import aggregates as A
from ..operators import runs as R
from .inputs import DAY, EVENTS, HOUR, RUNS, events, read

KEY, ORDER = ["user_id"], ["t", "event_id"]


def _runs(spark, sf_dir):
    return R.run_lengths(events(spark, sf_dir), KEY, ORDER, ["event_type"], "t")


def rle_runs(spark, sf_dir):
    """Runs of equal event types of each user."""
    return _runs(spark, sf_dir)


def rle_runs_gap(spark, sf_dir):
    """The same, broken by gaps over half a day as well."""
    return R.run_lengths(events(spark, sf_dir), KEY, ORDER, ["event_type"], "t", max_gap=12 * HOUR)


def rle_null_value(spark, sf_dir):
    """Runs in which null is a value of its own."""
    e = events(spark, sf_dir).withColumn("reading", F.nullif("event_type", F.lit("error")))
    return R.run_lengths(e, KEY, ORDER, ["reading"], "t")


def longest_run(spark, sf_dir):
    """The longest run of each user, the earliest of equals."""
    best = F.max(F.struct("samples", (-F.col("start_t")).alias("s"), "event_type", "end_t"))
    out = _runs(spark, sf_dir).groupBy("user_id").agg(best.alias("b"))
    return out.select("user_id", F.col("b.event_type").alias("event_type"), F.col("b.samples").alias("samples"), (-F.col("b.s")).alias("start_t"), F.col("b.end_t").alias("end_t"))


def run_length_histogram(spark, sf_dir):
    return R.length_histogram(_runs(spark, sf_dir), "event_type")


def stitched_runs(spark, sf_dir):
    """Runs of day-long chunks, joined again where they touch within a day."""
    e = events(spark, sf_dir).withColumn("chunk", F.floor(F.col("t") / DAY))
    chunks = R.run_lengths(e, ["user_id", "chunk"], ORDER, ["event_type"], "t")
    return R.stitch(chunks, KEY, ["event_type"], max_gap=DAY)


def sample_interval(spark, sf_dir):
    return R.sample_interval(events(spark, sf_dir), KEY, "t")


def state_case(spark, sf_dir):
    """States from probes, by precedence."""
    columns = F.when(F.col("k") % 11 == 0, F.col("k"))
    tag = F.when(F.col("event_type") == "error", F.lit("tag"))
    state = screen_state(columns, tag, F.coalesce(F.col("k") % 2 == 0, F.lit(False)), F.col("value") / 100)
    return events(spark, sf_dir).select("event_id", state.alias("state"))


def bridge_gaps(spark, sf_dir):
    """Runs after short ones between two 'view' runs became 'view'."""
    return R.bridge(_runs(spark, sf_dir).drop("run"), KEY, "event_type", "view", 4 * HOUR)


def state_segments(spark, sf_dir):
    """The full smoother: bridged and dwell-limited segments of each user."""
    dwell = {"view": 3 * HOUR, "click": 0.0, "purchase": 4 * HOUR, "signup": 8 * HOUR, "error": 3 * HOUR}
    return R.smooth(events(spark, sf_dir), KEY, ORDER, "event_type", "t", dwell, {"click": 4 * HOUR})


def session_windows(spark, sf_dir):
    """Sessions of a user: events at most six hours apart."""
    e = events(spark, sf_dir).withColumn("t_end", F.col("t"))
    return R.sessions(e, KEY, "t", "t_end", 6 * HOUR)


def span_sessions(spark, sf_dir):
    """Sessions of runs, which have a length: a gap counts from the latest end."""
    return R.sessions(_runs(spark, sf_dir), KEY, "start_t", "end_t", 2 * HOUR)


def state_occupancy(spark, sf_dir):
    """Time spent in each type's runs, their number, and the longest run."""
    length = F.col("end_t") - F.col("start_t")
    out = _runs(spark, sf_dir).groupBy("event_type").agg(F.sum(F.round(length).cast("bigint")).alias("total"), F.max(length).alias("longest"), F.count(F.lit(1)).alias("runs"))
    return out


def state_share(spark, sf_dir):
    """Each type's share of the time in runs, and its third longest run."""
    whole = _runs(spark, sf_dir).select("event_type", F.floor("start_t").alias("start_t"), F.floor("end_t").alias("end_t"))
    out = A.occupancy(whole, "event_type")
    return out.select("event_type", "total", "share", F.try_element_at("longest", F.lit(3)).alias("third"))


def adjacent_roles(spark, sf_dir):
    """Runs of one role in a conversation."""
    c = read(spark, sf_dir, "conversations")
    out = R.run_lengths(c, ["conv_id"], ["turn"], ["role"], "turn")
    return out.select("conv_id", "run", "role", F.col("start_t").alias("first_turn"), F.col("end_t").alias("last_turn"), F.col("samples").alias("turns"))


QUERIES = {f.__name__: f for f in (rle_runs, rle_runs_gap, rle_null_value, longest_run, run_length_histogram, stitched_runs, sample_interval, state_case, bridge_gaps, state_segments, session_windows, span_sessions, state_occupancy, state_share, adjacent_roles)}

_DWELL = "CASE r.state WHEN 'view' THEN 10800 WHEN 'purchase' THEN 14400 WHEN 'signup' THEN 28800 WHEN 'error' THEN 10800 ELSE 0 END"
ORACLE_SQL = {
    "state_segments": f"""WITH RECURSIVE {RUNS}, g AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS step FROM e),
iv AS (SELECT user_id, coalesce(median(step) FILTER (WHERE step > 0), 1.0) AS iv FROM g GROUP BY user_id), h AS (
  SELECT r.*, iv, CASE WHEN lag(event_type) OVER w = 'click' AND lead(event_type) OVER w = 'click' AND event_type <> 'click' AND end_t - start_t + iv <= 14400 THEN 'click' ELSE event_type END AS held
  FROM r JOIN iv USING (user_id) WINDOW w AS (PARTITION BY user_id ORDER BY start_t)
), b2 AS (SELECT *, CASE WHEN held IS DISTINCT FROM lag(held) OVER (PARTITION BY user_id ORDER BY start_t) THEN 1 ELSE 0 END AS brk2 FROM h
), n2 AS (SELECT *, sum(brk2) OVER (PARTITION BY user_id ORDER BY start_t ROWS UNBOUNDED PRECEDING) AS run2 FROM b2
), m AS (SELECT user_id, run2, min(held) AS state, min(start_t) AS s, max(end_t) AS e, sum(samples)::BIGINT AS n, min(iv) AS iv FROM n2 GROUP BY 1, 2
), f AS (
  SELECT user_id, min(iv) AS iv, 0::BIGINT AS step, list({{'state': state, 's': s, 'e': e, 'n': n}} ORDER BY s) AS runs FROM m GROUP BY user_id
  UNION ALL
  SELECT user_id, iv, step + 1, list_concat(list_concat(runs[1:a - 1], [{{'state': state, 's': runs[a].s, 'e': runs[b].e, 'n': list_sum(list_transform(runs[a:b], lambda r: r.n))::BIGINT}}]), runs[b + 1:])
  FROM (SELECT *, CASE WHEN i > 1 AND runs[i - 1].state = state THEN i - 1 ELSE i END AS a, CASE WHEN i < len(runs) AND runs[i + 1].state = state THEN i + 1 ELSE i END AS b FROM (
    SELECT *, runs[CASE WHEN i = 1 OR (i < len(runs) AND runs[i + 1].e - runs[i + 1].s > runs[i - 1].e - runs[i - 1].s) THEN i + 1 ELSE i - 1 END].state AS state FROM (
      SELECT *, list_min(list_filter(list_transform(runs, lambda r, k: CASE WHEN r.e - r.s + iv < {_DWELL} THEN {{'l': r.e - r.s + iv, 'k': k}} END), lambda x: x IS NOT NULL)).k AS i FROM f WHERE len(runs) > 1) WHERE i IS NOT NULL))
), z AS (SELECT user_id, iv, unnest(arg_max(runs, step)) AS r FROM (SELECT user_id, any_value(iv) AS iv, arg_max(runs, step) AS runs, max(step) AS step FROM f GROUP BY user_id) GROUP BY user_id, iv)
SELECT user_id, r.state AS event_type, r.s AS start_t, r.e + iv AS end_t, r.n AS samples FROM z""",
    "rle_runs": f"WITH {RUNS} SELECT * FROM r",
    "rle_runs_gap": f"""WITH {EVENTS}, b AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL OR t - lag(t) OVER w > 43200 THEN 1 ELSE 0 END AS brk
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM b)
SELECT user_id, run, min(event_type) AS event_type, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples FROM n GROUP BY user_id, run""",
    "rle_null_value": f"""WITH {EVENTS}, v AS (SELECT *, nullif(event_type, 'error') AS reading FROM e), b AS (
  SELECT *, CASE WHEN reading IS DISTINCT FROM lag(reading) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS brk
  FROM v WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM b)
SELECT user_id, run, min(reading) AS reading, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples FROM n GROUP BY user_id, run""",
    "longest_run": f"""WITH {RUNS}, k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY samples DESC, start_t) AS rn FROM r)
SELECT user_id, event_type, samples, start_t, end_t FROM k WHERE rn = 1""",
    "run_length_histogram": f"""WITH {RUNS} SELECT event_type, least(samples, 10) AS length, count(*)::BIGINT AS n, max(samples) AS longest
FROM r GROUP BY event_type, least(samples, 10)""",
    "stitched_runs": f"""WITH {EVENTS}, b AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL OR t - lag(t) OVER w > 86400 AND floor(t / 86400) <> floor(lag(t) OVER w / 86400) THEN 1 ELSE 0 END AS brk
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM b)
SELECT user_id, min(event_type) AS event_type, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples FROM n GROUP BY user_id, run""",
    "sample_interval": f"""WITH {EVENTS}, g AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS step FROM e)
SELECT user_id, coalesce(median(step) FILTER (WHERE step > 0), 1.0) AS interval FROM g GROUP BY user_id""",
    "state_case": f"""WITH {EVENTS} SELECT event_id, CASE WHEN k % 11 = 0 THEN 'boxscore' WHEN event_type = 'error' THEN 'replay'
  WHEN k % 2 = 0 THEN 'live' WHEN value / 100 > 0.15 THEN 'series' ELSE 'other' END AS state FROM e""",
    "bridge_gaps": f"""WITH {RUNS}, h AS (
  SELECT *, CASE WHEN lag(event_type) OVER w = 'view' AND lead(event_type) OVER w = 'view' AND event_type <> 'view' AND end_t - start_t <= 14400
            THEN 'view' ELSE event_type END AS held
  FROM r WINDOW w AS (PARTITION BY user_id ORDER BY start_t)
), b2 AS (
  SELECT *, CASE WHEN held IS DISTINCT FROM lag(held) OVER (PARTITION BY user_id ORDER BY start_t) THEN 1 ELSE 0 END AS brk2 FROM h
), n2 AS (SELECT *, sum(brk2) OVER (PARTITION BY user_id ORDER BY start_t ROWS UNBOUNDED PRECEDING) AS run2 FROM b2)
SELECT user_id, min(held) AS event_type, min(start_t) AS start_t, max(end_t) AS end_t, sum(samples)::BIGINT AS samples FROM n2 GROUP BY user_id, run2""",
    "session_windows": f"""WITH {EVENTS}, b AS (
  SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > 21600 THEN 1 ELSE 0 END AS brk FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM b)
SELECT user_id, session, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS items FROM n GROUP BY user_id, session""",
    "span_sessions": f"""WITH {RUNS}, m AS (
  SELECT *, max(end_t) OVER (PARTITION BY user_id ORDER BY start_t, end_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r
), s AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_t > reach + 7200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_t, end_t ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM m)
SELECT user_id, session, min(start_t) AS start_t, max(end_t) AS end_t, count(*)::BIGINT AS items FROM s GROUP BY user_id, session""",
    "state_occupancy": f"""WITH {RUNS} SELECT event_type, sum(round(end_t - start_t)::BIGINT)::BIGINT AS total, max(end_t - start_t) AS longest, count(*)::BIGINT AS runs
FROM r GROUP BY event_type""",
    "state_share": f"""WITH {RUNS}, l AS (SELECT event_type, floor(end_t)::BIGINT - floor(start_t)::BIGINT AS len, row_number() OVER (PARTITION BY event_type ORDER BY floor(end_t)::BIGINT - floor(start_t)::BIGINT DESC) AS rn FROM r)
SELECT event_type, sum(len)::BIGINT AS total, sum(len)::DOUBLE / (SELECT sum(len) FROM l)::DOUBLE AS share, max(len) FILTER (WHERE rn = 3) AS third FROM l GROUP BY event_type""",
    "adjacent_roles": """WITH b AS (
  SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER w OR lag(turn) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM b)
SELECT conv_id, run, min(role) AS role, min(turn) AS first_turn, max(turn) AS last_turn, count(*)::BIGINT AS turns FROM n GROUP BY conv_id, run""",
}
