"""Queries over changes, folds, boundaries and chains."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.exprs import is_drop
from ..operators import sequences as S
from ..operators import temporal_joins as J
from .inputs import DAY, EVENTS, HOUR, MINUTE, events, typed

KEY, ORDER = ["user_id"], ["t", "event_id"]


def _bucket():
    return F.floor(F.col("value") / 20).cast("bigint")


def reset_detect(spark, sf_dir):
    """Values that come down to the lowest bucket from a higher one."""
    e = events(spark, sf_dir).withColumn("bucket", _bucket())
    return S.changes(e, KEY, ORDER, ["bucket"], (F.col("bucket") == 0) & (F.col("prev_bucket") > 0)).select("event_id", "user_id", F.bround("t").cast("bigint").alias("at"), "prev_bucket")


def up_jump(spark, sf_dir):
    """Values that rise into a band."""
    rise = (F.col("value") > F.col("prev_value")) & F.col("value").between(43, 60)
    return S.changes(events(spark, sf_dir), KEY, ORDER, ["value"], rise, skip_null="value").select("event_id", "prev_value", "value")


def unit_step(spark, sf_dir):
    """Counters that step by exactly one within a day."""
    one = (F.col("k") == F.col("prev_k") + 1) & (F.col("t") - F.col("prev_t") <= DAY)
    return S.changes(events(spark, sf_dir), KEY, ORDER, ["k", "t"], one).select("event_id", F.col("prev_t").alias("earliest"), F.col("t").alias("latest"), F.col("prev_k").alias("before"), F.col("k").alias("after"))


def falls(spark, sf_dir):
    """Falls of a value to its lowest bucket within twelve hours."""
    e = events(spark, sf_dir).withColumn("level", _bucket())
    near = (F.col("prev_level") > 0) & (F.col("t") - F.col("prev_t") <= 12 * HOUR)
    return S.changes(e, KEY, ORDER, ["level", "t"], near & is_drop(F.col("prev_level"), F.col("level")), skip_null="level").select("event_id", "user_id", "t", F.col("prev_level").alias("before"))


def monotone_violations(spark, sf_dir):
    """Steps down between runs of k modulo 5 that last one, and two, samples."""
    from ..operators.runs import run_lengths

    e = events(spark, sf_dir).withColumn("c", F.col("k") % 5)
    r = run_lengths(e, KEY, ORDER, ["c"], "t")
    out = None
    for least in (1, 2):
        kept = r.where(F.col("samples") >= least)
        down = (F.col("c") < F.col("prev_c")) & (F.col("start_t") - F.col("prev_end_t")).between(0, 2 * DAY)
        n = S.changes(kept, KEY, ["start_t"], ["c", "end_t"], down).groupBy("user_id").agg(F.count(F.lit(1)).alias("falls")).withColumn("least", F.lit(least))
        out = n if out is None else out.unionByName(n)
    return out


def staircase_fold(spark, sf_dir):
    """The accepted staircase of (bucket, k modulo 6) of each user."""
    e = events(spark, sf_dir).select("user_id", "t", "event_id", _bucket().alias("l"), (F.col("k") % 6).alias("r"), F.col("t").alias("s"), F.col("t").alias("z"))
    out = S.staircase(e.where(F.col("l").isNotNull() & F.col("r").isNotNull()), KEY, ORDER, "l", "r", "s", "z")
    return out.select("user_id", "l", "r", F.col("s").alias("start_t"), F.col("z").alias("end_t"))


def staircase_gaps(spark, sf_dir):
    """Changes of the k series that are neither zero nor one."""
    return S.changes(events(spark, sf_dir), KEY, ORDER, ["k"], ~(F.col("k") - F.col("prev_k")).isin(0, 1)).select("event_id", "prev_k", "k")


def until_fall(spark, sf_dir):
    """Events of a user up to the first fall of k below its highest."""
    return S.up_to_fall(events(spark, sf_dir), KEY, ORDER, "k").select("event_id", "user_id", "k")


def duplicate_in_round(spark, sf_dir):
    """The same type twice in a user's day: a fragment within ten minutes, else
    a replay."""
    e = events(spark, sf_dir).withColumn("day", F.floor(F.col("t") / DAY).cast("bigint"))
    w = Window.partitionBy("user_id", "day", "event_type").orderBy("t", "event_id")
    gap = F.col("t") - F.lag("t").over(w)
    out = e.withColumn("gap", gap).where(F.col("gap").isNotNull())
    return out.select("event_id", "gap", F.when(F.col("gap") <= 10 * MINUTE, "fragment").otherwise("replay").alias("kind"))


def over_four(spark, sf_dir):
    """User days with more than four events, with fewer distinct types or not."""
    e = events(spark, sf_dir).withColumn("day", F.floor(F.col("t") / DAY).cast("bigint"))
    out = e.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_type").alias("types"))
    return out.where(F.col("n") > 4).withColumn("repeated", F.col("types") < F.col("n"))


def _named(boundaries):
    return boundaries.withColumn("witnesses", F.array_join("witnesses", ","))


def boundary_consensus(spark, sf_dir):
    """Instants of a user at which error, purchase and signup fall together."""
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    w = events(spark, sf_dir).where(F.col("event_type").isin("error", "purchase", "signup")).withColumn("rank", rank)
    return _named(S.consensus(w, KEY, "t", "event_type", "rank", DAY, 2))


def round_boundaries(spark, sf_dir):
    """The same where a witness may join a boundary once only."""
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    w = events(spark, sf_dir).where(F.col("event_type").isin("error", "purchase", "signup")).withColumn("rank", rank)
    return _named(S.consensus(w, KEY, "t", "event_type", "rank", DAY, 3, once=True))


def _segments(spark, sf_dir):
    """A user's time from one signup to the next."""
    s = typed(spark, sf_dir, "signup")
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return s.select("user_id", F.row_number().over(w).cast("bigint").alias("segment"), F.col("t").alias("start_t"), F.lead("t").over(w).alias("end_t"))


def _held(spark, sf_dir, kinds=None):
    """Events with the latest signup segment begun at or before them."""
    e = events(spark, sf_dir)
    if kinds:
        e = e.where(F.col("event_type").isin(*kinds))
    return J.asof(e, _segments(spark, sf_dir), KEY, "t", "start_t", ["segment", "start_t", "end_t"], tie=["segment"]).where(F.col("segment").isNotNull())


def interval_assign(spark, sf_dir):
    """Events counted per segment."""
    n = _held(spark, sf_dir).groupBy("user_id", "segment").agg(F.count(F.lit(1)).alias("events"), F.max("t").alias("last_t"))
    return _segments(spark, sf_dir).join(n, ["user_id", "segment"], "left").select("user_id", "segment", "start_t", "end_t", F.coalesce("events", F.lit(0)).alias("events"), "last_t")


def score_at(spark, sf_dir):
    """The last value of a user before each of its segments."""
    e = events(spark, sf_dir).select("user_id", F.col("t").alias("vt"), "value", "event_id")
    return J.asof(_segments(spark, sf_dir), e, KEY, "start_t", "vt", ["value", "event_id"], strict=True, tie=["event_id"]).select("user_id", "segment", "value")


def low_in_span(spark, sf_dir):
    """The lowest value inside each segment."""
    return _held(spark, sf_dir).groupBy("user_id", "segment").agg(F.min("value").alias("low"))


def outcome_case(spark, sf_dir):
    """How each segment ended: by error, by purchase, by time, or open."""
    n = _held(spark, sf_dir).groupBy("user_id", "segment").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "purchase").alias("buys"), F.min("value").alias("low"))
    kind = F.when((F.col("buys") > 0) & (F.col("low") <= 5), "detonation").when(F.col("buys") > 0, "plant").when(F.col("low") <= 0.6, "time").when(F.col("errors") > 0, "wipe")
    return n.select("user_id", "segment", kind.alias("outcome"))


def map_winner(spark, sf_dir):
    """Which of two counters rose from one segment to the next."""
    n = _held(spark, sf_dir).groupBy("user_id", "segment").agg((F.sum("k") % 4).alias("l"), (F.count(F.lit(1)) % 3).alias("r"))
    w = Window.partitionBy("user_id").orderBy("segment")
    dl, dr = F.lead("l").over(w) - F.col("l"), F.lead("r").over(w) - F.col("r")
    out = n.withColumn("dl", dl).withColumn("dr", dr).where(F.col("dl").isNotNull())
    return out.select("user_id", "segment", F.when((F.col("dl") == 1) & (F.col("dr") == 0), "left").when((F.col("dl") == 0) & (F.col("dr") == 1), "right").alias("winner"))


def chain_events(spark, sf_dir):
    """Sightings of a user followed down slots: one event per chain."""
    e = events(spark, sf_dir).select("user_id", "event_id", "t", (F.col("event_id") % 5).alias("slot"), (F.col("k") % 10).alias("width"), "event_type", (F.col("value") > 50).alias("medal"))
    c = S.chain_events(e, KEY, "t", "slot", ["width"], max_gap=2 * DAY, slack=3, tie=["event_id"])
    return S.chain_summary(c, KEY, "t", "slot", first=["event_type"], any_of=["medal"]).withColumn("slots", F.array_join("slots", ","))


def systematic_sample(spark, sf_dir):
    """Every tenth event of a user, from the first."""
    return S.every_nth(events(spark, sf_dir), KEY, ORDER, 10).select("event_id", "user_id")


def seeded_sample(spark, sf_dir):
    """The fifty events of each type whose seeded digests are least."""
    return S.seeded_sample(events(spark, sf_dir), ["event_type"], "event_id", 50, "7").select("event_id", "event_type")


QUERIES = {
    f.__name__: f
    for f in (reset_detect, up_jump, unit_step, falls, monotone_violations, staircase_fold, staircase_gaps, until_fall, duplicate_in_round, over_four, boundary_consensus, round_boundaries, interval_assign, score_at, low_in_span, outcome_case, map_winner, chain_events, systematic_sample, seeded_sample)
}

_W = "WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)"
_SEG = EVENTS + """, sg AS (
  SELECT user_id, row_number() OVER w AS segment, t AS start_t, lead(t) OVER w AS end_t FROM e WHERE event_type = 'signup' WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
), hd AS (SELECT e.*, sg.segment, sg.start_t, sg.end_t FROM e JOIN sg ON sg.user_id = e.user_id AND e.t >= sg.start_t AND (sg.end_t IS NULL OR e.t < sg.end_t))"""


def _consensus(needed: int, once: str) -> str:
    near = f"list_position(list_transform(out, lambda b: abs(b.t - q.t) <= 86400{once}), true)"
    return f"""WITH RECURSIVE {EVENTS}, q AS (
  SELECT user_id, t, event_type AS name, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END, t, event_type) AS i
  FROM e WHERE event_type IN ('error', 'purchase', 'signup')
), f AS (
  SELECT user_id, 0::BIGINT AS i, []::STRUCT(t DOUBLE, seen VARCHAR[])[] AS out FROM (SELECT DISTINCT user_id FROM q)
  UNION ALL
  SELECT f.user_id, q.i, CASE WHEN coalesce({near}, 0) = 0 THEN list_append(out, {{'t': q.t, 'seen': [q.name]}})
    ELSE list_transform(out, lambda b, n: CASE WHEN n = {near} THEN {{'t': b.t, 'seen': list_sort(list_distinct(list_append(b.seen, q.name)))}} ELSE b END) END
  FROM f JOIN q ON q.user_id = f.user_id AND q.i = f.i + 1
), l AS (SELECT user_id, unnest(arg_max(out, i)) AS b FROM f GROUP BY user_id)
SELECT user_id, b.t AS t, array_to_string(b.seen, ',') AS witnesses, len(b.seen) >= {needed} AS confirmed FROM l"""


_FITS = "q.t - c.t <= 172800 AND c.t < q.t AND c.slot >= q.slot AND abs(c.w - q.w) <= 3"
_AT = f"list_position(list_transform(live, lambda c: {_FITS} AND c.slot = list_min(list_transform(list_filter(live, lambda c: {_FITS}), lambda c: c.slot))), true)"
ORACLE_SQL = {
    "boundary_consensus": _consensus(2, ""),
    "round_boundaries": _consensus(3, " AND NOT list_contains(b.seen, q.name)"),
    "chain_events": f"""WITH RECURSIVE {EVENTS}, g AS (
  SELECT user_id, event_id, t, event_id % 5 AS slot, k % 10 AS w, event_type, value > 50 AS medal, CASE WHEN t - lag(t) OVER v > 172800 THEN 1 ELSE 0 END AS far FROM e WINDOW v AS (PARTITION BY user_id ORDER BY t, event_id % 5, event_id)
), q AS (SELECT *, row_number() OVER v AS i, sum(far) OVER (PARTITION BY user_id ORDER BY t, slot, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM g WINDOW v AS (PARTITION BY user_id ORDER BY t, slot, event_id)
), f AS (
  SELECT user_id, 0::BIGINT AS i, 0::BIGINT AS chain, []::STRUCT(t DOUBLE, slot BIGINT, w BIGINT)[] AS live FROM (SELECT DISTINCT user_id FROM q)
  UNION ALL
  SELECT f.user_id, q.i, CASE WHEN coalesce({_AT}, 0) = 0 THEN len(live) + 1 ELSE {_AT} END,
    CASE WHEN coalesce({_AT}, 0) = 0 THEN list_append(live, {{'t': q.t, 'slot': q.slot, 'w': q.w}}) ELSE list_transform(live, lambda c, n: CASE WHEN n = {_AT} THEN {{'t': q.t, 'slot': q.slot, 'w': q.w}} ELSE c END) END
  FROM f JOIN q ON q.user_id = f.user_id AND q.i = f.i + 1
), r AS (SELECT q.*, f.chain FROM q JOIN f USING (user_id, i)),
s AS (SELECT user_id, session, chain, min(t) AS t, arg_min(event_type, t) AS event_type, bool_or(medal) AS medal, count(*)::BIGINT AS frames, string_agg(slot::VARCHAR, ',' ORDER BY t) AS slots FROM r GROUP BY 1, 2, 3)
SELECT user_id, session, chain - min(chain) OVER (PARTITION BY user_id, session) AS chain, t, event_type, medal, frames, slots FROM s""",
    "systematic_sample": f"WITH {EVENTS}, q AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM e) SELECT event_id, user_id FROM q WHERE n % 10 = 1",
    "seeded_sample": f"WITH {EVENTS}, q AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5('7' || event_id::VARCHAR), event_id) AS n FROM e) SELECT event_id, event_type FROM q WHERE n <= 50",
    "reset_detect": f"""WITH {EVENTS}, b AS (SELECT *, floor(value / 20)::BIGINT AS bucket FROM e), p AS (SELECT *, lag(bucket) OVER w AS prev_bucket FROM b {_W})
SELECT event_id, user_id, round_even(t, 0)::BIGINT AS at, prev_bucket FROM p WHERE bucket = 0 AND prev_bucket > 0""",
    "up_jump": f"""WITH {EVENTS}, p AS (SELECT *, lag(value) OVER w AS prev_value FROM (SELECT * FROM e WHERE value IS NOT NULL) {_W})
SELECT event_id, prev_value, value FROM p WHERE value > prev_value AND value BETWEEN 43 AND 60""",
    "unit_step": f"""WITH {EVENTS}, p AS (SELECT *, lag(k) OVER w AS pk, lag(t) OVER w AS pt FROM e {_W})
SELECT event_id, pt AS earliest, t AS latest, pk AS before, k AS after FROM p WHERE k = pk + 1 AND t - pt <= 86400""",
    "falls": f"""WITH {EVENTS}, b AS (SELECT *, floor(value / 20)::BIGINT AS level FROM e WHERE value IS NOT NULL), p AS (SELECT *, lag(level) OVER w AS pl, lag(t) OVER w AS pt FROM b {_W})
SELECT event_id, user_id, t, pl AS before FROM p WHERE pl > 0 AND t - pt <= 43200 AND level = 0""",
    "monotone_violations": f"""WITH {EVENTS}, c AS (SELECT *, k % 5 AS c FROM e), b AS (
  SELECT *, CASE WHEN c IS DISTINCT FROM lag(c) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM c {_W}
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM b),
r AS (SELECT user_id, run, min(c) AS c, min(t) AS start_t, max(t) AS end_t, count(*) AS samples FROM n GROUP BY 1, 2), l(least) AS (VALUES (1), (2)),
q AS (SELECT r.*, least, lag(c) OVER v AS pc, lag(end_t) OVER v AS pe FROM r JOIN l ON samples >= least WINDOW v AS (PARTITION BY user_id, least ORDER BY start_t))
SELECT user_id, count(*)::BIGINT AS falls, least FROM q WHERE c < pc AND start_t - pe BETWEEN 0 AND 172800 GROUP BY user_id, least""",
    "staircase_gaps": f"WITH {EVENTS}, p AS (SELECT *, lag(k) OVER w AS prev_k FROM e {_W}) SELECT event_id, prev_k, k FROM p WHERE k - prev_k NOT IN (0, 1)",
    "until_fall": f"""WITH {EVENTS}, p AS (SELECT *, max(k) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM e),
f AS (SELECT *, max(CASE WHEN k < high THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS fell FROM p)
SELECT event_id, user_id, k FROM f WHERE fell = 0""",
    "staircase_fold": f"""WITH RECURSIVE {EVENTS}, q AS (
  SELECT user_id, t, floor(value / 20)::BIGINT AS l, k % 6 AS r, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM e WHERE value IS NOT NULL AND k IS NOT NULL
), f AS (
  SELECT user_id, i, l, r, t AS start_t, t AS end_t, 1::BIGINT AS step FROM q WHERE i = 1
  UNION ALL
  SELECT f.user_id, q.i, CASE WHEN q.l < f.l OR q.r < f.r THEN f.l ELSE q.l END, CASE WHEN q.l < f.l OR q.r < f.r THEN f.r ELSE q.r END,
    CASE WHEN q.l < f.l OR q.r < f.r OR (q.l = f.l AND q.r = f.r) THEN f.start_t ELSE q.t END,
    CASE WHEN q.l < f.l OR q.r < f.r THEN f.end_t ELSE q.t END,
    CASE WHEN q.l < f.l OR q.r < f.r OR (q.l = f.l AND q.r = f.r) THEN f.step ELSE f.step + 1 END
  FROM f JOIN q ON q.user_id = f.user_id AND q.i = f.i + 1
) SELECT user_id, l, r, start_t, max(end_t) AS end_t FROM f GROUP BY user_id, step, l, r, start_t""",
    "duplicate_in_round": f"""WITH {EVENTS}, p AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id, floor(t / 86400), event_type ORDER BY t, event_id) AS gap FROM e)
SELECT event_id, gap, CASE WHEN gap <= 600 THEN 'fragment' ELSE 'replay' END AS kind FROM p WHERE gap IS NOT NULL""",
    "over_four": f"""WITH {EVENTS} SELECT user_id, floor(t / 86400)::BIGINT AS day, count(*)::BIGINT AS n, count(DISTINCT event_type)::BIGINT AS types, count(DISTINCT event_type) < count(*) AS repeated
FROM e GROUP BY 1, 2 HAVING count(*) > 4""",
    "interval_assign": f"""WITH {_SEG}, n AS (SELECT user_id, segment, count(*)::BIGINT AS events, max(t) AS last_t FROM hd GROUP BY 1, 2)
SELECT sg.user_id, sg.segment, sg.start_t, sg.end_t, coalesce(n.events, 0) AS events, n.last_t FROM sg LEFT JOIN n USING (user_id, segment)""",
    "score_at": f"""WITH {_SEG}, j AS (SELECT sg.user_id, sg.segment, e.value, row_number() OVER (PARTITION BY sg.user_id, sg.segment ORDER BY e.t DESC NULLS LAST, e.event_id DESC) AS rn
  FROM sg LEFT JOIN e ON e.user_id = sg.user_id AND e.t < sg.start_t) SELECT user_id, segment, value FROM j WHERE rn = 1""",
    "low_in_span": f"WITH {_SEG} SELECT user_id, segment, min(value) AS low FROM hd GROUP BY 1, 2",
    "outcome_case": f"""WITH {_SEG}, n AS (SELECT user_id, segment, count_if(event_type = 'error') AS errors, count_if(event_type = 'purchase') AS buys, min(value) AS low FROM hd GROUP BY 1, 2)
SELECT user_id, segment, CASE WHEN buys > 0 AND low <= 5 THEN 'detonation' WHEN buys > 0 THEN 'plant' WHEN low <= 0.6 THEN 'time' WHEN errors > 0 THEN 'wipe' END AS outcome FROM n""",
    "map_winner": f"""WITH {_SEG}, n AS (SELECT user_id, segment, sum(k) % 4 AS l, count(*) % 3 AS r FROM hd GROUP BY 1, 2),
d AS (SELECT *, lead(l) OVER v - l AS dl, lead(r) OVER v - r AS dr FROM n WINDOW v AS (PARTITION BY user_id ORDER BY segment))
SELECT user_id, segment, CASE WHEN dl = 1 AND dr = 0 THEN 'left' WHEN dl = 0 AND dr = 1 THEN 'right' END AS winner FROM d WHERE dl IS NOT NULL""",
}
