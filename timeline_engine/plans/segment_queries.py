"""Maps, rounds, hills, halves and checks of broadcasts made from ``events``.

Each user is a broadcast. Its events, in order, are its instants, 100 seconds
apart; a signup starts a map (the board and the score fall to zero), a purchase
a round (full clock, full lives, one side scores), and the other types read the
clock, the lives and the labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import settled
from . import segments as G
from .inputs import EVENTS, events

STEP = 100.0
LEFT, RIGHT = ("p0", "p1", "p2", "p3"), ("p4", "p5", "p6", "p7")


def _kind(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def _clock(seconds: Column) -> Column:
    left = seconds % 60
    return F.concat(F.floor(seconds / 60).cast("string"), F.lit(":"), F.when(left.between(0, 9), "0").otherwise(""), left.cast("string"))


def _instants(spark, sf_dir: str) -> DataFrame:
    """(vod, at, event_type, k, end_at, m, l, r, who): m counts signups, l and r the
    purchases of even and odd k since the last one, who is the last click's
    player."""
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    e = events(spark, sf_dir).select(F.col("user_id").alias("vod"), (F.row_number().over(w) * STEP).alias("at"), "event_type", F.coalesce("k", F.lit(0)).alias("k"))
    so_far = Window.partitionBy("vod").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_map = Window.partitionBy("vod", "m").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    player = F.concat(F.lit("p"), (F.col("k") % 8).cast("string"))
    e = e.withColumn("end_at", F.max("at").over(Window.partitionBy("vod")) + STEP)
    e = e.withColumns({"m": F.count_if(_kind("signup")).over(so_far), "who": F.last(F.when(_kind("click"), player), ignorenulls=True).over(so_far)})
    scored = lambda odd: F.count_if(_kind("purchase") & (F.col("k") % 2 == odd)).over(in_map)
    return settled(e.withColumns({"l": scored(0), "r": scored(1)}))


def _header(e: DataFrame) -> DataFrame:
    said = lambda field, value, *kinds: F.when(_kind(*kinds), F.struct(F.lit(field).alias("field"), value.cast("string").alias("value")))
    clock = F.when(_kind("purchase"), F.lit(90)).when(_kind("view"), F.col("k") % 80).otherwise(43 + F.col("k") % 3)
    lives = lambda x: F.when(_kind("purchase"), F.lit(4)).otherwise(x)
    half = F.when(F.col("k") % 3 == 0, "FIRST HALF").when(F.col("k") % 3 == 1, "SECOND HALF").otherwise("PLAY")
    fields = [
        said("maps_left", F.col("m"), "signup"), said("maps_right", F.lit(0), "signup"),
        said("score_left", F.col("l"), "signup", "purchase"), said("score_right", F.col("r"), "signup", "purchase"),
        said("clock", _clock(clock), "purchase", "view", "error"),
        said("lives_left", lives(F.col("k") % 5), "purchase", "click"), said("lives_right", lives(F.floor(F.col("k") / 5) % 5), "purchase", "click"),
        said("rotation", _clock(F.col("k") % 60), "purchase", "click"), said("substrip", half, "view"),
    ]
    runs = e.select("vod", "end_at", F.col("at").alias("start_t"), F.explode(F.array_compact(F.array(*fields))).alias("x")).select("vod", "end_at", "start_t", "x.*")
    upto = F.lead("start_t").over(Window.partitionBy("vod", "field").orderBy("start_t")) - 1
    last = F.when(F.startswith("field", F.lit("maps")), F.col("end_at")).otherwise(F.col("start_t") + STEP - 1)
    runs = runs.withColumn("end_t", F.coalesce(upto, last)).drop("end_at")
    whole = e.select("vod", "end_at").distinct().select("vod", F.lit(0.0).alias("start_t"), F.lit("best_of").alias("field"), F.lit(G.BEST_OF).alias("value"), F.col("end_at").alias("end_t"))
    return settled(runs.unionByName(whole))


def _board(e: DataFrame) -> DataFrame:
    upto = F.coalesce(F.lead("at").over(Window.partitionBy("vod").orderBy("at")) - 1, F.col("at") + STEP - 1)
    # Kept before each row becomes eight, which costs less than to read these back.
    b = settled(e.where(_kind("signup", "purchase")).withColumn("upto", upto).drop("end_at", "m", "who", "event_type"))
    label = F.element_at(F.array(*map(F.lit, G.MODE_OF_LABEL), F.lit(None)), (F.col("k") % 4 + 1).cast("int"))
    n = (F.col("l") + F.col("r")).cast("bigint")
    slots = b.select("vod", F.col("at").alias("start_t"), F.col("upto").alias("end_t"), (F.col("k") % 5 + 1).alias("samples"), label.alias("stat_label"), n.alias("kills"), n.alias("deaths"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("n"))
    name = F.concat(F.lit("p"), F.col("n").cast("string"))
    return slots.select("vod", F.when(F.col("n") < 4, "left").otherwise("right").alias("side"), (F.col("n") % 4).alias("slot"), "start_t", "end_t", "samples", F.col("n").alias("number"), name.alias("name"), "kills", "deaths", "stat_label", F.lit(None).cast("string").alias("gutter"))


def _sides(e: DataFrame) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("name"), F.lit(s).alias("side")) for s, team in (("left", LEFT), ("right", RIGHT)) for p in team])).alias("x")
    return e.select("vod").distinct().select("vod", each).select("vod", "x.*")


def _deaths(e: DataFrame) -> DataFrame:
    return e.where(_kind("click")).select("vod", F.col("at").alias("t"), F.col("who").alias("victim"))


def _maps(spark, sf_dir: str):
    e = _instants(spark, sf_dir)
    header = G.Header(_header(e))
    return e, header, G.map_windows(_board(e), header)


def broadcast_maps(spark, sf_dir):
    """Maps of each broadcast with their mode, series score, witnesses, winner."""
    _, _, maps = _maps(spark, sf_dir)
    out = maps.join(G.map_winners(maps), ["vod", "number"], "left")
    return out.select("vod", F.col("number").cast("bigint").alias("number"), "start_t", "end_t", "mode", F.col("pips.l").alias("pips"), F.array_join("witnesses", ",").alias("witnesses"), "winner")


def _rounds(spark, sf_dir):
    e, header, maps = _maps(spark, sf_dir)
    return e, maps, G.close_from_series(G.rounds(header, maps, _deaths(e), _sides(e)), G.map_winners(maps))


def broadcast_rounds(spark, sf_dir):
    """Rounds with winner, plant, least lives, who was wiped and how they ended."""
    _, _, found = _rounds(spark, sf_dir)
    whole = {c: F.col(c).cast("bigint") for c in ("map", "number", "low_left", "low_right")}
    return found.withColumns(whole).withColumn("witnesses", F.array_join("witnesses", ",")).drop("last")


def broadcast_subdivisions(spark, sf_dir):
    """Rounds, hills and halves of every map, by its mode."""
    _, header, maps = _maps(spark, sf_dir)
    return G.subdivisions(header, maps).withColumns({c: F.col(c).cast("bigint") for c in ("map", "number")})


def broadcast_checks(spark, sf_dir):
    """How many rounds of a map break each rule."""
    e, maps, found = _rounds(spark, sf_dir)
    out = G.round_checks(settled(found), _deaths(e), _sides(e), G.map_winners(maps))
    return out.withColumn("map", F.col("map").cast("bigint"))


def broadcast_falls(spark, sf_dir):
    """Falls of the shown player's counter, matched to deaths of that player."""
    e = _instants(spark, sf_dir)
    said = lambda kind, field, value: e.where(_kind(kind)).select("vod", "end_at", F.col("at").alias("start_t"), F.lit(field).alias("field"), value.cast("string").alias("value"))
    panel = said("view", "hp", F.when(F.col("k") % 3 == 0, 0).otherwise(F.col("k"))).unionByName(said("click", "name", F.col("who")))
    upto = F.lead("start_t").over(Window.partitionBy("vod", "field").orderBy("start_t")) - 1
    panel = settled(panel.withColumn("end_t", F.coalesce(upto, "end_at")).drop("end_at"))
    deaths = e.where(_kind("view") & (F.col("k") % 3 == 0)).select("vod", (F.col("at") + F.col("k") % 7 / 10).alias("t"), F.col("who").alias("victim"))
    return G.pair_falls(G.hp_falls(panel), deaths).select("vod", "player", "t", F.round("matched_t", 3).alias("matched_t"), F.round("delta", 3).alias("delta"))


def broadcast_localise(spark, sf_dir):
    """Steps of the board's counters against the events that should cause them."""
    e = _instants(spark, sf_dir)
    player = lambda x: F.concat(F.lit("p"), x.cast("string"))
    feed = e.where(_kind("purchase")).select("vod", (F.col("at") + F.col("k") % 5 / 2).alias("t"), player(F.col("k") % 8).alias("attacker"), player(F.floor(F.col("k") / 8) % 8).alias("victim"))
    return G.localise_report(G.localise(G.increments(_board(e)), feed))


QUERIES = {f.__name__: f for f in (broadcast_maps, broadcast_rounds, broadcast_subdivisions, broadcast_checks, broadcast_falls, broadcast_localise)}

_BASE = f"""{EVENTS}, s0 AS (
  SELECT user_id AS vod, 100.0::DOUBLE * row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS tm, event_type, coalesce(k, 0) AS k FROM e
), s1 AS (
  SELECT *, count(CASE WHEN event_type = 'signup' THEN 1 END) OVER (PARTITION BY vod ORDER BY tm) AS m,
         last_value(CASE WHEN event_type = 'click' THEN 'p' || (k % 8) END IGNORE NULLS) OVER (PARTITION BY vod ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS who
  FROM s0
), b AS (
  SELECT *, count(CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN 1 END) OVER (PARTITION BY vod, m ORDER BY tm) AS l,
         count(CASE WHEN event_type = 'purchase' AND k % 2 = 1 THEN 1 END) OVER (PARTITION BY vod, m ORDER BY tm) AS r
  FROM s1
)"""
_MAPS = f"""{_BASE}, d AS (
  SELECT *, lag(event_type) OVER w AS before, coalesce(lead(tm) OVER w - 1, tm + 99) AS until, lag(tm) OVER w AS before_tm
  FROM b WHERE event_type IN ('signup', 'purchase') WINDOW w AS (PARTITION BY vod ORDER BY tm)
), x AS (
  SELECT vod, tm, CASE WHEN before IS NULL THEN 'first_reading' ELSE 'pip_advance,score_reset,scoreboard_reset' END AS witnesses
  FROM d WHERE before IS NULL OR (event_type = 'signup' AND before = 'purchase' AND m > 1)
), ne AS (
  SELECT *, row_number() OVER (PARTITION BY vod ORDER BY tm) AS number, lead(tm) OVER (PARTITION BY vod ORDER BY tm) AS nxt FROM x
), mp AS (
  SELECT ne.vod, ne.number, ne.tm AS start_t, max(d.until) AS end_t, any_value(ne.witnesses) AS witnesses
  FROM ne JOIN d ON d.vod = ne.vod AND d.tm >= ne.tm AND (ne.nxt IS NULL OR d.tm < ne.nxt) GROUP BY ne.vod, ne.number, ne.tm
), vm AS (
  SELECT mp.vod, mp.number, CASE d.k % 4 WHEN 0 THEN 'hardpoint' WHEN 1 THEN 'search_and_destroy' WHEN 2 THEN 'overload' END AS mode, sum(8 * (d.k % 5 + 1)) AS w, min(d.tm) AS seen
  FROM mp JOIN d ON d.vod = mp.vod AND d.tm BETWEEN mp.start_t AND mp.end_t WHERE d.k % 4 < 3 GROUP BY ALL
), md AS (SELECT vod, number, mode FROM vm QUALIFY row_number() OVER (PARTITION BY vod, number ORDER BY w DESC, seen, mode) = 1
), pp AS (
  SELECT mp.vod, mp.number, min(b.m) AS pips FROM mp JOIN b ON b.vod = mp.vod AND b.tm BETWEEN mp.start_t AND mp.end_t WHERE b.event_type = 'signup' GROUP BY ALL
), maps AS (
  SELECT mp.*, md.mode, pp.pips, CASE WHEN lead(pp.pips) OVER (PARTITION BY mp.vod ORDER BY mp.number) = pp.pips + 1 THEN 'left' END AS winner
  FROM mp LEFT JOIN md USING (vod, number) LEFT JOIN pp USING (vod, number)
)"""
_PARTS = f"""{_MAPS}, cm AS (
  SELECT b.*, maps.number AS map, maps.mode,
         CASE event_type WHEN 'purchase' THEN 90 WHEN 'view' THEN k % 80 WHEN 'error' THEN 43 + k % 3 END AS s,
         CASE WHEN event_type = 'purchase' OR event_type = 'click' THEN k % 60 END AS rot
  FROM b JOIN maps ON b.vod = maps.vod AND b.tm BETWEEN maps.start_t AND maps.end_t WHERE b.m >= 1
), cl AS (SELECT *, lag(s) OVER (PARTITION BY vod, map ORDER BY tm) AS ps FROM cm WHERE mode = 'search_and_destroy' AND s IS NOT NULL
), l0 AS (
  SELECT vod, tm, m, CASE event_type WHEN 'purchase' THEN 4 ELSE k % 5 END AS ll, CASE event_type WHEN 'purchase' THEN 4 ELSE (k // 5) % 5 END AS lr
  FROM b WHERE event_type IN ('purchase', 'click')
), l1 AS (SELECT * FROM l0 WINDOW w AS (PARTITION BY vod ORDER BY tm) QUALIFY lag(ll) OVER w IS NULL OR ll <> lag(ll) OVER w OR lr <> lag(lr) OVER w
), lv AS (
  SELECT l1.*, maps.number AS map, lag(ll) OVER w AS pl, lag(lr) OVER w AS pr FROM l1 JOIN maps ON l1.vod = maps.vod AND l1.tm BETWEEN maps.start_t AND maps.end_t
  WHERE l1.m >= 1 AND maps.mode = 'search_and_destroy' WINDOW w AS (PARTITION BY l1.vod, maps.number ORDER BY l1.tm)
), c1 AS (
  SELECT * FROM b WHERE event_type IN ('signup', 'purchase') WINDOW w AS (PARTITION BY vod ORDER BY tm) QUALIFY lag(l) OVER w IS NULL OR l <> lag(l) OVER w OR r <> lag(r) OVER w
), sc AS (
  SELECT c1.*, maps.number AS map, l - lag(l) OVER w AS dl, r - lag(r) OVER w AS dr FROM c1 JOIN maps ON c1.vod = maps.vod AND c1.tm BETWEEN maps.start_t AND maps.end_t
  WHERE c1.m >= 1 AND maps.mode = 'search_and_destroy' WINDOW w AS (PARTITION BY c1.vod, maps.number ORDER BY c1.tm)
), st AS (SELECT vod, map, tm, CASE WHEN dl = 1 THEN 'left' ELSE 'right' END AS side FROM sc WHERE (dl = 1 AND dr = 0) OR (dl = 0 AND dr = 1)
), ed AS (
  SELECT vod, map, tm, string_agg(name, ',' ORDER BY name) AS witnesses, 'search_and_destroy' AS mode FROM (
    SELECT vod, map, tm, 'score_step' AS name FROM st
    UNION ALL SELECT vod, map, tm, 'clock_reset' FROM cl WHERE s > ps AND s >= 80
    UNION ALL SELECT vod, map, tm, 'lives_reset' FROM lv WHERE ll = 4 AND lr = 4 AND (pl <> 4 OR pr <> 4)) GROUP BY ALL
  UNION ALL
  SELECT vod, map, tm, 'rotation_reset', mode FROM (SELECT *, lag(rot) OVER (PARTITION BY vod, map ORDER BY tm) AS p FROM cm WHERE mode = 'hardpoint' AND rot IS NOT NULL) WHERE rot > p
  UNION ALL
  SELECT vod, map, tm, 'substrip', mode FROM (SELECT vod, map, mode, k % 3 AS h, min(tm) AS tm FROM cm WHERE mode = 'overload' AND event_type = 'view' AND k % 3 < 2 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vod, map ORDER BY tm) > 1
), pt AS (
  SELECT vod, map, mode, row_number() OVER w AS number, tm AS start_t, coalesce(lead(tm) OVER w, map_end) AS end_t, witnesses FROM (
    SELECT vod, number AS map, mode, start_t AS tm, 'map_start' AS witnesses, end_t AS map_end FROM maps WHERE mode IS NOT NULL
    UNION ALL SELECT ed.vod, ed.map, ed.mode, ed.tm, ed.witnesses, maps.end_t FROM ed JOIN maps ON maps.vod = ed.vod AND maps.number = ed.map)
  WINDOW w AS (PARTITION BY vod, map ORDER BY tm)
)"""
_ROUNDS = f"""{_PARTS}, rp AS (SELECT * FROM pt WHERE mode = 'search_and_destroy'
), p0 AS (
  SELECT rp.*, (SELECT CASE WHEN count(*) = 1 THEN min(side) END FROM st WHERE st.vod = rp.vod AND st.map = rp.map AND st.tm BETWEEN rp.end_t - 25 AND rp.end_t + 25) AS won,
         (SELECT min(tm) FROM cl WHERE cl.vod = rp.vod AND cl.map = rp.map AND cl.tm >= rp.start_t AND cl.tm < rp.end_t AND s > ps AND s BETWEEN 43 AND 45) AS plant_t,
         (SELECT min(ll) FROM lv WHERE lv.vod = rp.vod AND lv.map = rp.map AND lv.tm >= rp.start_t AND lv.tm < rp.end_t) AS low_left,
         (SELECT min(lr) FROM lv WHERE lv.vod = rp.vod AND lv.map = rp.map AND lv.tm >= rp.start_t AND lv.tm < rp.end_t) AS low_right,
         lead(number) OVER (PARTITION BY vod, map ORDER BY number) IS NULL AS last
  FROM rp
), dv AS (
  SELECT rp.vod, rp.map, rp.number, who AS victim, CASE WHEN who < 'p4' THEN 'left' ELSE 'right' END AS side
  FROM rp JOIN b ON b.vod = rp.vod AND b.tm >= rp.start_t AND b.tm < rp.end_t WHERE b.event_type = 'click' AND b.m >= 1
), gn AS (
  SELECT vod, map, number, min(side) AS gone FROM (SELECT vod, map, number, side, count(DISTINCT victim) AS n FROM dv GROUP BY ALL) WHERE n >= 4 GROUP BY ALL
), p1 AS (
  SELECT p0.*, CASE WHEN low_left = 0 THEN 'left' WHEN low_right = 0 THEN 'right' END AS wiped0,
         (SELECT min(s) FROM cl WHERE cl.vod = p0.vod AND cl.map = p0.map AND cl.tm >= p0.start_t AND cl.tm < p0.end_t) AS least_clock,
         (SELECT min(s) FROM cl WHERE cl.vod = p0.vod AND cl.map = p0.map AND cl.tm >= p0.start_t AND cl.tm < p0.end_t AND cl.tm >= p0.plant_t) AS least_bomb
  FROM p0
), p2 AS (
  SELECT p1.*, gn.gone,
         CASE WHEN plant_t IS NOT NULL THEN CASE WHEN coalesce(least_bomb <= 0.6, false) OR coalesce(won = wiped0, false) THEN 'detonation' ELSE 'plant' END
              WHEN least_clock <= 0.6 THEN 'time' WHEN wiped0 IS NOT NULL OR least_clock IS NOT NULL THEN 'wipe' END AS ended,
         CASE WHEN won IS NOT NULL THEN 'score_step' WHEN last AND wiped0 IS NOT NULL THEN 'lives_wipe' WHEN last AND gn.gone IS NOT NULL THEN 'killfeed_wipe' END AS by1
  FROM p1 LEFT JOIN gn USING (vod, map, number)
), p3 AS (
  SELECT *, CASE WHEN won IS NOT NULL THEN won WHEN by1 = 'lives_wipe' THEN CASE wiped0 WHEN 'left' THEN 'right' ELSE 'left' END
                 WHEN by1 = 'killfeed_wipe' THEN CASE gone WHEN 'left' THEN 'right' ELSE 'left' END END AS w1
  FROM p2
), rounds AS (
  SELECT p3.vod, p3.map, p3.number, p3.start_t, p3.end_t, p3.witnesses, coalesce(w1, CASE WHEN last THEN maps.winner END) AS winner,
         CASE WHEN last AND w1 IS NULL AND maps.winner IS NOT NULL THEN 'series_pips' ELSE by1 END AS decided_by, plant_t, low_left, low_right,
         CASE WHEN by1 = 'killfeed_wipe' THEN gone ELSE wiped0 END AS wiped, CASE WHEN by1 = 'killfeed_wipe' THEN coalesce(ended, 'wipe') ELSE ended END AS outcome
  FROM p3 LEFT JOIN maps ON maps.vod = p3.vod AND maps.number = p3.map
)"""

ORACLE_SQL = {
    "broadcast_maps": f"WITH {_MAPS} SELECT vod, number, start_t, end_t, mode, pips, witnesses, winner FROM maps",
    "broadcast_rounds": f"WITH {_ROUNDS} SELECT * FROM rounds",
    "broadcast_subdivisions": f"""WITH {_PARTS}
SELECT vod, map, number, start_t, end_t, CASE mode WHEN 'search_and_destroy' THEN 'round' WHEN 'hardpoint' THEN 'hill' ELSE 'half' END AS kind FROM pt""",
    "broadcast_checks": f"""WITH {_ROUNDS}, hd AS (
  SELECT rp.vod, rp.map, rp.number, who AS victim FROM rp JOIN b ON b.vod = rp.vod AND b.tm >= rp.start_t AND b.tm < rp.end_t WHERE b.event_type = 'click'
), tw AS (SELECT vod, map, count(DISTINCT number) AS n FROM (SELECT vod, map, number FROM hd GROUP BY vod, map, number, victim HAVING count(*) > 1) GROUP BY ALL
), mn AS (SELECT vod, map, count(DISTINCT number) AS n FROM (SELECT vod, map, number FROM hd GROUP BY vod, map, number, victim < 'p4' HAVING count(*) > 4) GROUP BY ALL
), t AS (
  SELECT vod, map, count_if(number > 1 AND len(string_split(witnesses, ',')) < 3) AS unseen, count_if(outcome IS NULL) AS open, count_if(winner IS NULL) AS undecided,
         count_if(winner = 'left') AS l, count_if(winner = 'right') AS r FROM rounds GROUP BY ALL
), c AS (
  SELECT t.*, coalesce(tw.n, 0) AS twice, coalesce(mn.n, 0) AS many,
         CASE WHEN maps.winner IS NOT NULL AND maps.winner IS DISTINCT FROM CASE WHEN l > r THEN 'left' WHEN r > l THEN 'right' END THEN 1 ELSE 0 END AS apart
  FROM t LEFT JOIN tw USING (vod, map) LEFT JOIN mn USING (vod, map) LEFT JOIN maps ON maps.vod = t.vod AND maps.number = t.map
)
SELECT vod, map, x.c AS "check", x.n::BIGINT AS wrong FROM (
  SELECT vod, map, unnest([{{'c': 'witnesses', 'n': unseen}}, {{'c': 'outcome', 'n': open}}, {{'c': 'winner', 'n': undecided}}, {{'c': 'one death each', 'n': twice}}, {{'c': 'deaths of a side', 'n': many}}, {{'c': 'rounds and map', 'n': apart}}]) AS x FROM c)""",
    "broadcast_falls": f"""WITH {_BASE}, v AS (
  SELECT *, lag(CASE WHEN k % 3 = 0 THEN 0 ELSE k END) OVER (PARTITION BY vod ORDER BY tm) AS before FROM b WHERE event_type = 'view'
), f AS (SELECT vod, who AS player, tm AS t, k FROM v WHERE k % 3 = 0 AND before > 0 AND who IS NOT NULL
), j AS (SELECT *, CASE WHEN abs(tm + k % 7 / 10 - (tm + 0.167)) <= 0.35 THEN tm + k % 7 / 10 END AS matched FROM (SELECT vod, player, t, k, t AS tm FROM f))
SELECT vod, player, t, round(matched, 3) AS matched_t, round(matched - (t + 0.167), 3) AS delta FROM j""",
    "broadcast_localise": f"""WITH {_BASE}, d AS (
  SELECT *, lag(tm) OVER (PARTITION BY vod ORDER BY tm) AS before FROM b WHERE event_type IN ('signup', 'purchase')
), i AS (SELECT vod, f.field, 'p' || p.p AS player, tm FROM d, (VALUES ('kills'), ('deaths')) f(field), range(8) p(p) WHERE event_type = 'purchase' AND before IS NOT NULL
), v AS (
  SELECT vod, 'kills' AS field, 'p' || (k % 8) AS player, tm, k % 5 / 2 AS late FROM b WHERE event_type = 'purchase'
  UNION ALL SELECT vod, 'deaths', 'p' || ((k // 8) % 8), tm, k % 5 / 2 FROM b WHERE event_type = 'purchase'
), a AS (SELECT i.vod, i.field, v.late FROM i LEFT JOIN v ON v.vod = i.vod AND v.field = i.field AND v.player = i.player AND v.tm = i.tm AND v.late <= 1.5
), x AS (SELECT v.vod, v.field FROM v LEFT JOIN i ON v.vod = i.vod AND v.field = i.field AND v.player = i.player AND v.tm = i.tm AND v.late <= 1.5 WHERE i.vod IS NULL
), u AS (
  SELECT vod, field, 1 AS inc, CASE WHEN late IS NOT NULL THEN 1 ELSE 0 END AS hit, late, 0 AS extra FROM a UNION ALL SELECT vod, field, 0, 0, NULL, 1 FROM x
)
SELECT vod, field, sum(inc)::BIGINT AS increments, sum(hit)::BIGINT AS matched, (sum(inc) - sum(hit))::BIGINT AS lost, sum(extra)::BIGINT AS invented, median(late) AS median_delta FROM u GROUP BY ALL""",
}
