"""Queries over parameter grids, named clusters, panels, and busy keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import naming as N
from ..operators import panels as P
from ..operators import runs as R
from ..operators import sweeps as W
from ..operators import temporal_joins as J
from .inputs import DAY, EVENTS, events, typed

KEY = ["user_id"]
GAPS, SLACKS, FRAMES = (1 * DAY, 2 * DAY), (1, 3), (1, 2)
PARTS = 16


def chain_sweep(spark, sf_dir):
    """Chains of sightings at each setting against the clicks of a user."""
    e = events(spark, sf_dir)
    seen = e.select("user_id", "event_id", "t", (F.col("event_id") % 5).alias("slot"), (F.col("k") % 10).alias("width"), (F.col("k") % 7).alias("x0"), F.floor(F.col("value")).alias("x1"))
    counts = W.chain_grid(seen, KEY, "t", "slot", {"widths": ["width"], "anchors": ["x0", "x1"]}, GAPS, SLACKS, FRAMES, tie=["event_id"])
    clicks = e.where(F.col("event_type") == "click").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return W.grid_scores(counts, clicks, KEY, "n")


def icon_names(spark, sf_dir):
    """Icons of views named by the tool on screen while their user is shown."""
    until = F.lead("t").over(Window.partitionBy("user_id").orderBy("t", "event_id"))

    def runs(kind: str, value):
        r = typed(spark, sf_dir, kind).withColumn("end_t", F.least(F.coalesce(until, F.col("t") + DAY), F.col("t") + DAY))
        return r.groupBy("user_id", F.col("t").alias("start_t")).agg(F.max_by(F.struct("end_t", value.alias("value")), "event_id").alias("r")).select("user_id", "start_t", "r.*")

    named = lambda letter, n: F.concat(F.lit(letter), (F.col("k") % n).cast("string"))
    views = typed(spark, sf_dir, "view").select("user_id", "event_id", "t", named("icon", 6).alias("icon"), named("p", 3).alias("actor"), (F.col("value") / 100).alias("distance"))
    held = N.values_at(views, {"shown": runs("click", named("p", 3)), "tool": runs("error", named("g", 4))}, KEY, "t")
    votes = held.where((F.col("shown") == F.col("actor")) & F.col("tool").isNotNull())
    return N.cluster_names(votes, "icon", "tool", "distance", ["t", "event_id"], alike=0.05, least=20)


def rle_one_key(spark, sf_dir):
    """Runs of equal types over all events as one key, cut into ranges."""
    return R.run_lengths(events(spark, sf_dir), [], ["t", "event_id"], ["event_type"], "t", parts=PARTS)


def asof_one_key(spark, sf_dir):
    """Each error with the latest purchase of anyone before it, in ranges."""
    bought = typed(spark, sf_dir, "purchase").select(F.col("t").alias("bought_t"), F.col("event_id").alias("bought_id"))
    errors = typed(spark, sf_dir, "error").select("event_id", "t")
    return J.asof(errors, bought, [], "t", "bought_t", ["bought_t", "bought_id"], strict=True, tie=["bought_id"], parts=PARTS)


def _panel(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"live": F.col("k") % 7 != 0, "drawn": F.col("event_type") != "error", "level": F.when(F.col("k") % 5 > 0, F.col("k") % 3), "kind": F.nullif("event_type", F.lit("signup"))})
    return P.panel_runs(e, KEY, ["t", "event_id"], "t", ["level", "kind"], "live", "drawn")


def panel_runs(spark, sf_dir):
    """Runs of two fields of a user's panel, parted where it isn't live or drawn."""
    return _panel(spark, sf_dir)[0]


def panel_counts(spark, sf_dir):
    """Samples of a user's panel that are live, drawn, and unread by field."""
    return _panel(spark, sf_dir)[1]


QUERIES = {f.__name__: f for f in (chain_sweep, icon_names, rle_one_key, asof_one_key, panel_runs, panel_counts)}

_APART = "CASE WHEN f.features = 'widths' THEN abs(c.w - q.w) <= f.slack ELSE abs(c.x0 - q.x0) <= f.slack AND abs(c.x1 - q.x1) <= f.slack END"
_FITS = f"q.t - c.t <= f.max_gap AND c.t < q.t AND c.slot >= q.slot AND {_APART}"

_PANEL = EVENTS + """, p AS (
  SELECT user_id, t, event_id, coalesce(k % 7 <> 0, false) AS live, coalesce(event_type <> 'error', false) AS drawn, CASE WHEN k % 5 > 0 THEN k % 3 END AS level, nullif(event_type, 'signup') AS kind FROM e
)"""

ORACLE_SQL = {
    "panel_runs": f"""WITH {_PANEL}, u AS (
  SELECT user_id, t, event_id, live AND drawn AS fit, f.field, CASE f.field WHEN 'level' THEN level::VARCHAR ELSE kind END AS value FROM p, (VALUES ('level'), ('kind')) f(field)
), b AS (
  SELECT *, CASE WHEN lag(fit) OVER w IS DISTINCT FROM true OR value IS DISTINCT FROM lag(value) OVER w THEN 1 ELSE 0 END AS brk FROM u WINDOW w AS (PARTITION BY user_id, field ORDER BY t, event_id)
), n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id, field ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM b)
SELECT user_id, field, any_value(value) AS value, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples FROM n WHERE fit GROUP BY user_id, field, run""",
    "panel_counts": f"""WITH {_PANEL}, c AS (
  SELECT user_id, count_if(live) AS a, count_if(live AND drawn) AS b, count_if(live AND drawn AND level IS NULL) AS c, count_if(live AND drawn AND kind IS NULL) AS d FROM p GROUP BY user_id
) SELECT user_id, x.what AS what, x.n::BIGINT AS n FROM (SELECT user_id, unnest([{{'what': 'live', 'n': a}}, {{'what': 'drawn', 'n': b}}, {{'what': 'unread level', 'n': c}}, {{'what': 'unread kind', 'n': d}}]) AS x FROM c)""",
    "chain_sweep": f"""WITH RECURSIVE {EVENTS}, q AS (
  SELECT user_id, t, event_id % 5 AS slot, k % 10 AS w, k % 7 AS x0, floor(value)::BIGINT AS x1, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id % 5, event_id) AS i FROM e
), st AS (SELECT * FROM (VALUES ('widths'), ('anchors')) a(features), (VALUES (86400.0::DOUBLE), (172800.0::DOUBLE)) b(max_gap), (VALUES (1.0::DOUBLE), (3.0::DOUBLE)) c(slack)
), f AS (
  SELECT user_id, features, max_gap, slack, 0::BIGINT AS i, 0::BIGINT AS chain, 0::BIGINT AS n, []::STRUCT(t DOUBLE, slot BIGINT, w BIGINT, x0 BIGINT, x1 BIGINT, id BIGINT)[] AS live FROM (SELECT DISTINCT user_id FROM q), st
  UNION ALL
  SELECT user_id, features, max_gap, slack, i, coalesce(best, n + 1), CASE WHEN best IS NULL THEN n + 1 ELSE n END,
    list_append(list_filter(live, lambda c: t - c.t <= max_gap AND c.id IS DISTINCT FROM best), {{'t': t, 'slot': slot, 'w': w, 'x0': x0, 'x1': x1, 'id': coalesce(best, n + 1)}})
  FROM (
    SELECT f.user_id, f.features, f.max_gap, f.slack, f.n, f.live, q.i, q.t, q.slot, q.w, q.x0, q.x1,
           list_min(list_transform(list_filter(f.live, lambda c: {_FITS}), lambda c: {{'slot': c.slot, 'id': c.id}})).id AS best
    FROM f JOIN q ON q.user_id = f.user_id AND q.i = f.i + 1)
), c AS (SELECT user_id, features, max_gap, slack, chain, count(*) AS frames FROM f WHERE i > 0 GROUP BY ALL
), n AS (SELECT user_id, features, max_gap, slack, m.min_frames, count_if(frames >= m.min_frames) AS events FROM c, (VALUES (1), (2)) m(min_frames) GROUP BY ALL
), w AS (SELECT user_id, count(*) AS want FROM e WHERE event_type = 'click' GROUP BY ALL
), s AS (
  SELECT features, max_gap, slack, min_frames, sum(events)::BIGINT AS events, sum(abs(events - coalesce(want, 0)))::BIGINT AS error, sum(greatest(events - coalesce(want, 0), 0))::BIGINT AS excess
  FROM n LEFT JOIN w USING (user_id) GROUP BY ALL
)
SELECT *, row_number() OVER (ORDER BY error, excess, features, max_gap, slack, min_frames) = 1 AS best FROM s""",
    "icon_names": f"""WITH {EVENTS}, v AS (
  SELECT *, (SELECT arg_max({{'t': c.t, 'x': 'p' || (c.k % 3)}}, (c.t, c.event_id)) FROM (SELECT t, event_id, k, user_id FROM e WHERE event_type = 'click') c WHERE c.user_id = v.user_id AND c.t <= v.t) AS shown,
         (SELECT arg_max({{'t': g.t, 'x': 'g' || (g.k % 4)}}, (g.t, g.event_id)) FROM (SELECT t, event_id, k, user_id FROM e WHERE event_type = 'error') g WHERE g.user_id = v.user_id AND g.t <= v.t) AS tool
  FROM e v WHERE event_type = 'view'
), g AS (
  SELECT 'icon' || (k % 6) AS icon, tool.x AS tool, count(*) AS n, median(value / 100) AS med, min((t, event_id)) AS seen
  FROM v WHERE shown.x = 'p' || (k % 3) AND t <= shown.t + 86400 AND t <= tool.t + 86400 GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY icon ORDER BY n DESC, seen, tool) AS rn FROM g
), b AS (SELECT r.*, w.med AS best, w.tool AS winner, w.n AS led, r.tool IN (SELECT tool FROM r WHERE rn = 1) AS leads FROM r JOIN r w ON w.icon = r.icon AND w.rn = 1)
SELECT icon, string_agg(tool, ' / ' ORDER BY tool) FILTER (WHERE rn = 1 OR (abs(med - best) <= 0.05 AND n >= 20 AND NOT leads)) AS label, any_value(winner) AS winner, any_value(led)::BIGINT AS led, sum(n)::BIGINT AS pairings
FROM b GROUP BY icon""",
    "rle_one_key": f"""WITH {EVENTS}, b AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM e WINDOW w AS (ORDER BY t, event_id)
), n AS (SELECT *, sum(brk) OVER (ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM b)
SELECT run::BIGINT AS run, min(event_type) AS event_type, min(t) AS start_t, max(t) AS end_t, count(*)::BIGINT AS samples FROM n GROUP BY run""",
    "asof_one_key": f"""WITH {EVENTS}, p AS (
  SELECT event_id, t, event_type, last_value(CASE WHEN event_type = 'purchase' THEN {{'t': t, 'id': event_id}} END IGNORE NULLS)
    OVER (ORDER BY t, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b
  FROM e WHERE event_type IN ('error', 'purchase')
) SELECT event_id, t, b.t AS bought_t, b.id AS bought_id FROM p WHERE event_type = 'error'""",
}
