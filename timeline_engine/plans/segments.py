"""Maps, rounds, hills and halves of a broadcast, from its run caches.

Inputs, all keyed by ``vod`` (one broadcast):

- header runs: vod, field, value (text), start_t, end_t
- board runs: vod, side, slot, start_t, end_t, samples, number, name, kills,
  deaths, stat_label, gutter
- events: vod, t, attacker, victim

Broadcasts are independent, so each operator partitions by vod, and by map
where there is one. A run's end is its last sample: run and map spans are
closed, those of rounds, hills and halves half-open.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clock_seconds, half_even, is_drop, long_enough
from ..operators import aggregates as A
from ..operators import matching as M
from ..operators import sequences as S
from ..operators import temporal_joins as J
from ..operators.storage import settled

#: Seconds, counts and labels of the broadcast's format.
LEAST_RUN = 0.5
BEST_OF = "9"
SLOTS = 8
MAP_TOLERANCE, ROUND_TOLERANCE = 2.0, 25.0
FULL_CLOCK = 80
PLANT_CLOCK = (43, 45)
EXPIRED = 0.6
LIVES = 4
MODE_OF_LABEL = {"TIME": "hardpoint", "PLNT": "search_and_destroy", "OVLD": "overload"}
ROUNDS_MODE, HILLS_MODE, HALVES_MODE = "search_and_destroy", "hardpoint", "overload"
HP_OFFSET, HP_WINDOW = 0.167, 0.35

VOD = ["vod"]


class Header:
    """Header runs with the series derived from them; those used more than once
    are computed once."""

    def __init__(self, runs: DataFrame):
        self.runs = runs

    @classmethod
    def of(cls, header: DataFrame | Header) -> Header:
        return header if isinstance(header, Header) else cls(header)

    def field(self, field: str, least: float = LEAST_RUN) -> DataFrame:
        return self.runs.where((F.col("field") == field) & (F.col("end_t") - F.col("start_t") >= least))

    @cached_property
    def series_spans(self) -> DataFrame:
        """Spans that the header calls part of this series."""
        return self.runs.where((F.col("field") == "best_of") & (F.col("value") == BEST_OF)).select("vod", "start_t", "end_t")

    def pair_plan(self, left: str, right: str) -> DataFrame:
        """``pair_series`` of two fields inside the series, from one scan."""
        long = F.col("end_t") - F.col("start_t") >= LEAST_RUN
        run = F.struct(F.col("start_t").alias("start"), F.col("end_t").alias("end"), "value")
        side = lambda field: F.when((F.col("field") == field) & long, run)
        until = F.when((F.col("field") == "best_of") & (F.col("value") == BEST_OF), F.col("end_t"))
        seen = self.runs.where(F.col("field").isin(left, right, "best_of")).select("vod", F.col("start_t").alias("t"), side(left).alias("_left"), side(right).alias("_right"), until.alias("_until"))
        return J.pairs_begun(seen, VOD, True)

    def pair(self, left: str, right: str) -> DataFrame:
        """Runs of a two-sided numeric field inside the series: vod, start_t,
        end_t, l, r."""
        out = self.pair_plan(left, right)
        number = lambda c: F.col(c).try_cast("bigint")
        return settled(out.select("vod", "start_t", "end_t", number("left_value").alias("l"), number("right_value").alias("r")))

    @cached_property
    def scores(self) -> DataFrame:
        return self.pair("score_left", "score_right")

    @cached_property
    def map_pairs(self) -> DataFrame:
        return self.pair("maps_left", "maps_right")

    @cached_property
    def lives(self) -> DataFrame:
        return self.pair("lives_left", "lives_right")

    @cached_property
    def pips(self) -> DataFrame:
        """The series score as a staircase that never falls."""
        return settled(S.staircase(self.map_pairs, VOD, ["start_t"], "l", "r"))

    @cached_property
    def live(self) -> DataFrame:
        """Spans of the present state of the series: those of the staircase,
        each cut half a second before the map score first falls inside it."""
        spans = self.pips.select("vod", "start_t", "end_t")
        scores = self.scores.select("vod", F.col("start_t").alias("t"), "l", "r")
        inside = J.interval_join(scores, spans.withColumn("s", F.col("start_t")), VOD, "t", width=600.0)
        w = Window.partitionBy("vod", "s").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
        fell = (F.col("l") < F.max("l").over(w)) | (F.col("r") < F.max("r").over(w))
        first = inside.withColumn("fell", F.coalesce(fell, F.lit(False))).where("fell").groupBy("vod", F.col("s").alias("start_t")).agg(F.min("t").alias("cut"))
        return settled(spans.join(first, ["vod", "start_t"], "left").select("vod", "start_t", F.coalesce(F.col("cut") - 0.5, F.col("end_t")).alias("end_t")))

    def in_live(self, rows: DataFrame, t: str = "start_t") -> DataFrame:
        """Rows whose instant lies in a live span."""
        return J.covered(rows, self.live, VOD, t)


def _changed(series: DataFrame, when: Column, keys: list[str] = VOD) -> DataFrame:
    return S.changes(series, keys, ["start_t"], ["l", "r"], when)


def pip_advances(header: DataFrame | Header) -> DataFrame:
    """(vod, t): the series score grew by one map."""
    grew = F.col("l") + F.col("r") == F.col("prev_l") + F.col("prev_r") + 1
    return _changed(Header.of(header).pips, grew).select("vod", half_even(F.col("start_t")).cast("double").alias("t")).distinct()


def score_resets(header: DataFrame | Header) -> DataFrame:
    """(vod, t): the map score came back to 0-0."""
    zero = (F.col("l") == 0) & (F.col("r") == 0) & ((F.col("prev_l") != 0) | (F.col("prev_r") != 0))
    return _changed(Header.of(header).scores, zero).select("vod", half_even(F.col("start_t")).cast("double").alias("t")).distinct()


def board_resets(board: DataFrame, quorum: int = SLOTS) -> DataFrame:
    """(vod, t): kills and deaths of at least ``quorum`` slots fell to zero in
    one second."""
    slot = ["vod", "side", "slot"]
    zero = (F.col("kills") == 0) & (F.col("deaths") == 0) & ((F.col("prev_kills") > 0) | (F.col("prev_deaths") > 0))
    hits = S.changes(board, slot, ["start_t"], ["kills", "deaths"], zero, skip_null="kills")
    seconds = hits.select("vod", half_even(F.col("start_t")).cast("double").alias("t"), "side", "slot").distinct()
    return seconds.groupBy("vod", "t").agg(F.count(F.lit(1)).alias("slots")).where(F.col("slots") >= quorum).select("vod", "t")


def split_foreign(board: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ours, theirs): runs whose number is on the roster under another name
    belong to a recap of another match. The roster is the weighted mode."""
    named = board.where(F.col("number").isNotNull() & F.col("name").isNotNull())
    roster = A.weighted_mode(named, ["vod", "number"], "name", F.col("samples"), F.col("start_t")).select("vod", "number", F.col("name").alias("_roster"))
    marked = board.join(roster, ["vod", "number"], "left")
    foreign = F.coalesce(F.col("_roster") != F.col("name"), F.lit(False))
    return marked.where(~foreign).select(*board.columns), marked.where(foreign).select(*board.columns)


def map_boundaries(board: DataFrame, header: DataFrame | Header) -> DataFrame:
    """(vod, t, witnesses, confirmed): confirmed by all three witnesses."""
    h = Header.of(header)
    named = [("scoreboard_reset", board_resets(board)), ("pip_advance", pip_advances(h)), ("score_reset", score_resets(h))]
    all_ = None
    for rank, (name, seen) in enumerate(named):
        one = seen.select("vod", "t", F.lit(name).alias("name"), F.lit(rank).alias("rank"))
        all_ = one if all_ is None else all_.unionByName(one)
    return S.consensus(all_, VOD, "t", "name", "rank", MAP_TOLERANCE, 3)


def map_windows(board: DataFrame, header: DataFrame | Header) -> DataFrame:
    """(vod, number, start_t, end_t, mode, pips, witnesses), one row a map.

    Edges are the first reading and the confirmed boundaries; an edge without
    readings gives no map but keeps its number."""
    h = Header.of(header)
    read = board.where(F.col("kills").isNotNull())
    begin = read.groupBy("vod").agg(F.min("start_t").alias("t")).withColumn("witnesses", F.array(F.lit("first_reading")))
    edges = begin.unionByName(map_boundaries(board, h).where("confirmed").select("vod", "t", "witnesses"))
    w = Window.partitionBy("vod").orderBy("t")
    edges = settled(edges.withColumn("number", F.row_number().over(w)))
    held = J.asof(read.select("vod", "start_t", "end_t"), edges.select("vod", "t", "number"), VOD, "start_t", "t", ["t", "number"], tie=["number"])
    maps = held.where(F.col("number").isNotNull()).groupBy("vod", "number").agg(F.max("end_t").alias("end_t"))
    maps = settled(edges.join(maps, ["vod", "number"]).select("vod", "number", F.col("t").alias("start_t"), "end_t", "witnesses"))
    spans = maps.select("vod", "number", "start_t", "end_t")
    label = F.element_at(F.create_map(*[F.lit(x) for kv in MODE_OF_LABEL.items() for x in kv]), F.col("stat_label"))
    voted = board.withColumn("mode", label).where(F.col("mode").isNotNull()).select("vod", F.col("start_t").alias("at"), "mode", "samples")
    modes = A.weighted_mode(J.interval_join(voted, spans, VOD, "at", width=600.0), ["vod", "number"], "mode", F.col("samples"), F.col("at")).drop("weight")
    pips = h.map_pairs.select("vod", F.col("start_t").alias("at"), F.struct("l", "r").alias("pips"))
    modal = A.weighted_mode(J.interval_join(pips, spans, VOD, "at", width=600.0), ["vod", "number"], "pips", F.lit(1), F.col("at")).drop("weight")
    out = maps.join(modes, ["vod", "number"], "left").join(modal, ["vod", "number"], "left")
    return settled(out.select("vod", "number", "start_t", "end_t", "mode", "pips", "witnesses"))


def map_winners(maps: DataFrame) -> DataFrame:
    """(vod, number, winner): whose count of maps grew by the next map."""
    w = Window.partitionBy("vod").orderBy("number")
    nxt = F.lead("pips").over(w)
    out = maps.withColumn("n", nxt).withColumn("last", F.lead("number").over(w).isNull()).where(~F.col("last"))
    side = F.when(F.col("n.l") == F.col("pips.l") + 1, "left").when(F.col("n.r") == F.col("pips.r") + 1, "right")
    return out.select("vod", "number", side.alias("winner"))


def in_maps(rows: DataFrame, maps: DataFrame, t: str = "start_t") -> DataFrame:
    """Rows with the number of the map that covers them (closed spans)."""
    spans = maps.select("vod", F.col("number").alias("map"), F.col("start_t").alias("_lo"), F.col("end_t").alias("_hi"))
    return J.interval_join(rows, spans, VOD, t, "_lo", "_hi", width=600.0).drop("_lo", "_hi")


MAP = ["vod", "map"]


def clock_series(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """(vod, map, start_t, s): parsed clock readings; those unread are left out
    before any are compared."""
    h = Header.of(header)
    runs = h.runs.where((F.col("field") == "clock") & long_enough(F.col("value"), F.col("start_t"), F.col("end_t"), LEAST_RUN))
    read = runs.select("vod", "start_t", clock_seconds(F.col("value")).alias("s")).where(F.col("s").isNotNull())
    return settled(in_maps(h.in_live(read), maps))


def _rises(clock: DataFrame, into: Column, name: str) -> DataFrame:
    up = (F.col("s") > F.col("prev_s")) & into
    return S.changes(clock, MAP, ["start_t"], ["s"], up).select(*MAP, F.col("start_t").alias("t"), F.lit(name).alias("name"))


def clock_resets(clock: DataFrame) -> DataFrame:
    return _rises(clock, F.col("s") >= FULL_CLOCK, "clock_reset")


def plants(clock: DataFrame) -> DataFrame:
    return _rises(clock, F.col("s").between(*PLANT_CLOCK), "plant")


def lives_series(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    h = Header.of(header)
    return settled(in_maps(h.in_live(h.lives), maps))


def score_steps(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """(vod, map, t, side): exactly one side's map score grew by one."""
    h = Header.of(header)
    dl, dr = F.col("l") - F.col("prev_l"), F.col("r") - F.col("prev_r")
    side = F.when((dl == 1) & (dr == 0), "left").when((dl == 0) & (dr == 1), "right")
    found = S.changes(in_maps(h.in_live(h.scores), maps), MAP, ["start_t"], ["l", "r"], side.isNotNull())
    return settled(found.select(*MAP, F.col("start_t").alias("t"), side.alias("side")))


def lives_resets(lives: DataFrame) -> DataFrame:
    full = (F.col("l") == LIVES) & (F.col("r") == LIVES) & ((F.col("prev_l") != LIVES) | (F.col("prev_r") != LIVES))
    return S.changes(lives, MAP, ["start_t"], ["l", "r"], full).select(*MAP, F.col("start_t").alias("t"))


def round_boundaries(clock: DataFrame, lives: DataFrame, steps: DataFrame) -> DataFrame:
    """(vod, map, t, witnesses, confirmed), from the clock and lives series and
    the score steps of maps played in rounds."""
    named = [("clock_reset", clock_resets(clock)), ("lives_reset", lives_resets(lives)), ("score_step", steps)]
    all_ = None
    for rank, (name, seen) in enumerate(named):
        one = seen.select(*MAP, "t", F.lit(name).alias("name"), F.lit(rank).alias("rank"))
        all_ = one if all_ is None else all_.unionByName(one)
    return S.consensus(all_, MAP, "t", "name", "rank", ROUND_TOLERANCE, 3, once=True)


def _numbered(maps: DataFrame, edges: DataFrame) -> DataFrame:
    """(vod, map, number, start_t, end_t, witnesses) from the map's start and
    further edges; the last ends with the map."""
    begin = maps.select("vod", F.col("number").alias("map"), F.col("start_t").alias("t"), F.array(F.lit("map_start")).alias("witnesses"))
    both = begin.unionByName(edges.select(*MAP, "t", "witnesses"))
    w = Window.partitionBy(*MAP).orderBy("t")
    both = both.withColumn("number", F.row_number().over(w)).withColumn("next", F.lead("t").over(w))
    ends = maps.select("vod", F.col("number").alias("map"), F.col("end_t").alias("map_end"))
    return both.join(ends, MAP).select(*MAP, "number", F.col("t").alias("start_t"), F.coalesce("next", "map_end").alias("end_t"), "witnesses")


def _held(rows: DataFrame, parts: DataFrame, t: str) -> DataFrame:
    """Rows of a map with the part (half-open) that covers them."""
    spans = parts.select(*MAP, "number", F.col("start_t").alias("_lo"), F.col("end_t").alias("_hi"))
    return J.interval_join(rows, spans, MAP, t, "_lo", "_hi", closed=False, width=60.0).drop("_lo", "_hi")


def rounds(header: DataFrame | Header, maps: DataFrame, events: DataFrame | None = None, sides: DataFrame | None = None) -> DataFrame:
    """Rounds with winner, plant, least lives, who was wiped and how it ended.

    The winner is the side whose score alone steps within the tolerance of the
    round's end. The last round has no such step: a wiped side loses it, by its
    lives or by four distinct victims (``sides``: vod, name, side)."""
    h = Header.of(header)
    maps = maps.where(F.col("mode") == ROUNDS_MODE)
    series, lives, steps = clock_series(h, maps), lives_series(h, maps), score_steps(h, maps)
    parts = settled(_numbered(maps, round_boundaries(series, lives, steps)))
    part = [*MAP, "number"]
    steps = steps.select(*MAP, F.col("t").alias("at"), "side")
    ends = parts.select(*part, (F.col("end_t") - ROUND_TOLERANCE).alias("_lo"), (F.col("end_t") + ROUND_TOLERANCE).alias("_hi"))
    won = J.interval_join(steps, ends, MAP, "at", "_lo", "_hi", width=60.0).groupBy(*part).agg(F.count(F.lit(1)).alias("steps"), F.min("side").alias("side"))
    clock = series.select(*MAP, F.col("start_t").alias("at"), "s")
    planted = _held(plants(series).select(*MAP, F.col("t").alias("at")), parts, "at").groupBy(*part).agg(F.min("at").alias("plant_t"))
    low = _held(lives.select(*MAP, F.col("start_t").alias("at"), "l", "r"), parts, "at").groupBy(*part).agg(F.min("l").alias("low_left"), F.min("r").alias("low_right"))
    out = settled(parts.join(won, part, "left").join(planted, part, "left").join(low, part, "left"))
    ticks = _held(clock, parts, "at").join(out.select(*part, "plant_t"), part)
    seen = ticks.groupBy(*part).agg(F.min("s").alias("least_clock"), F.min(F.when(F.col("at") >= F.col("plant_t"), F.col("s"))).alias("least_bomb"))
    out = out.join(seen, part, "left").withColumn("winner", F.when(F.col("steps") == 1, F.col("side")))
    wiped = F.when(F.col("low_left") == 0, "left").when(F.col("low_right") == 0, "right")
    out = out.withColumn("wiped", wiped)
    bomb = F.coalesce(F.col("least_bomb") <= EXPIRED, F.lit(False)) | F.coalesce(F.col("winner") == F.col("wiped"), F.lit(False))
    ended = (
        F.when(F.col("plant_t").isNotNull(), F.when(bomb, "detonation").otherwise("plant"))
        .when(F.col("least_clock") <= EXPIRED, "time")
        .when(F.col("wiped").isNotNull() | F.col("least_clock").isNotNull(), "wipe")
    )
    out = out.withColumn("outcome", ended)
    w = Window.partitionBy(*MAP).orderBy("number")
    out = out.withColumn("last", F.lead("number").over(w).isNull())
    if events is not None and sides is not None:
        hits = in_maps(h.in_live(events.where(F.col("victim").isNotNull()), "t"), maps, "t")
        dead = _held(hits, parts, "t").join(sides.select("vod", F.col("name").alias("victim"), F.col("side").alias("victim_side")), ["vod", "victim"])
        lost = dead.groupBy(*part, "victim_side").agg(F.count_distinct("victim").alias("n")).where(F.col("n") >= LIVES).groupBy(*part).agg(F.min("victim_side").alias("gone"))
        out = out.join(lost, part, "left")
    else:
        out = out.withColumn("gone", F.lit(None).cast("string"))
    other = lambda c: F.when(F.col(c) == "left", "right").when(F.col(c) == "right", "left")
    open_ = F.col("last") & F.col("winner").isNull()
    by = F.when(F.col("winner").isNotNull(), "score_step").when(open_ & F.col("wiped").isNotNull(), "lives_wipe").when(open_ & F.col("gone").isNotNull(), "killfeed_wipe")
    out = out.withColumn("decided_by", by)
    closed = F.coalesce("winner", F.when(F.col("decided_by") == "lives_wipe", other("wiped")).when(F.col("decided_by") == "killfeed_wipe", other("gone")))
    feed = F.col("decided_by") == "killfeed_wipe"
    out = out.withColumn("winner", closed).withColumn("outcome", F.when(feed, F.coalesce("outcome", F.lit("wipe"))).otherwise(F.col("outcome"))).withColumn("wiped", F.when(feed, F.col("gone")).otherwise(F.col("wiped")))
    return out.select(*part, "start_t", "end_t", "witnesses", "winner", "decided_by", "plant_t", "low_left", "low_right", "wiped", "outcome", "last")


def close_from_series(found: DataFrame, winners: DataFrame) -> DataFrame:
    """Gives a last round without winner to the winner of its map."""
    named = winners.select("vod", F.col("number").alias("map"), F.col("winner").alias("_w"))
    out = found.join(named, MAP, "left")
    take = F.col("last") & F.col("winner").isNull() & F.col("_w").isNotNull()
    out = out.withColumn("decided_by", F.when(take, "series_pips").otherwise(F.col("decided_by"))).withColumn("winner", F.when(take, F.col("_w")).otherwise(F.col("winner")))
    return out.select(*found.columns)


def hills(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """Hills, at each rise of the rotation timer; an unread timer parts its
    neighbours."""
    maps = maps.where(F.col("mode") == HILLS_MODE)
    h = Header.of(header)
    runs = h.field("rotation").select("vod", "start_t", clock_seconds(F.col("value")).alias("s"))
    timer = in_maps(h.in_live(runs), maps)
    edges = _rises(timer, F.lit(True), "rotation_reset").withColumn("witnesses", F.array("name"))
    return _numbered(maps, edges)


def halves(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """Halves, at the first sight of each label that names one; the first of
    them begins with the map."""
    maps = maps.where(F.col("mode") == HALVES_MODE)
    h = Header.of(header)
    runs = h.field("substrip").where(F.endswith("value", F.lit("HALF"))).select("vod", "start_t", "value")
    first = in_maps(h.in_live(runs), maps).groupBy(*MAP, "value").agg(F.min("start_t").alias("t"))
    w = Window.partitionBy(*MAP).orderBy("t")
    edges = first.withColumn("n", F.row_number().over(w)).where(F.col("n") > 1).withColumn("witnesses", F.array(F.lit("substrip")))
    return _numbered(maps, edges)


def subdivisions(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """(vod, map, kind, number, start_t, end_t) of every map, by its mode."""
    cols = [*MAP, "number", "start_t", "end_t"]
    h = Header.of(header)
    named = [("round", rounds(h, maps)), ("hill", hills(h, maps)), ("half", halves(h, maps))]
    out = None
    for kind, parts in named:
        one = parts.select(*cols).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


def staircase_gaps(header: DataFrame | Header, maps: DataFrame) -> DataFrame:
    """Changes of the map score that are neither none nor one point."""
    step = F.col("l") + F.col("r") - F.col("prev_l") - F.col("prev_r")
    h = Header.of(header)
    return S.changes(in_maps(h.in_live(h.scores), maps), MAP, ["start_t"], ["l", "r"], ~step.isin(0, 1))


def duplicate_victims(events: DataFrame, parts: DataFrame, fragment: float = 10.0) -> DataFrame:
    """Deaths of one player in one round after the first: a fragment of the
    same sighting within ``fragment`` seconds, else a replay."""
    held = J.interval_join(events.where(F.col("victim").isNotNull()), parts.select("vod", "map", "number", F.col("start_t").alias("_lo"), F.col("end_t").alias("_hi")), VOD, "t", "_lo", "_hi", closed=False)
    w = Window.partitionBy("vod", "map", "number", "victim").orderBy("t")
    out = held.withColumn("gap", F.col("t") - F.lag("t").over(w)).where(F.col("gap").isNotNull())
    return out.select("vod", "map", "number", "victim", "t", "gap", F.when(F.col("gap") <= fragment, "fragment").otherwise("replay").alias("kind"))


def hp_falls(panel: DataFrame, to_zero: bool = True, least: float = 0, max_gap: float = 1.0) -> DataFrame:
    """(vod, player, t): falls of the panel's counter, with the same name on it
    before and after."""
    hp = panel.where(F.col("field") == "hp").select("vod", "start_t", "end_t", F.col("value").try_cast("bigint").alias("hp"))
    names = panel.where((F.col("field") == "name") & F.col("value").isNotNull()).select("vod", "start_t", "end_t", F.col("value").alias("name"))
    fell = (F.col("prev_hp") > 0) & (F.col("start_t") - F.col("prev_end_t") <= max_gap) & is_drop(F.col("prev_hp"), F.col("hp"), to_zero, least)
    found = S.changes(hp, VOD, ["start_t"], ["hp", "end_t"], fell, skip_null="hp")
    at = lambda d, t, name: J.value_at(d, names.withColumnRenamed("name", name), VOD, t, [name])
    both = at(at(found.select("vod", "start_t", "prev_end_t"), "prev_end_t", "was"), "start_t", "name")
    return both.where(F.col("was") == F.col("name")).select("vod", F.col("name").alias("player"), F.col("start_t").alias("t"))


def pair_falls(falls: DataFrame, events: DataFrame, offset: float = HP_OFFSET, window: float = HP_WINDOW) -> DataFrame:
    """Falls matched one-to-one to deaths of the same player."""
    deaths = events.where(F.col("victim").isNotNull()).select("vod", F.col("victim").alias("player"), "t")
    return M.match_events(falls.select("vod", "player", "t"), deaths, ["vod", "player"], window, offset)


def increments(board: DataFrame, max_gap: float = 1.0) -> DataFrame:
    """(vod, player, field, before, after, earliest, latest, skull): steps of
    exactly one of a slot's counters under one name."""
    slot = ["vod", "side", "slot"]
    prev = S.with_previous(board, slot, ["start_t"], ["name", "kills", "deaths", "end_t", "gutter"])
    prev = prev.where((F.col("name") == F.col("prev_name")) & (F.col("start_t") - F.col("prev_end_t") <= max_gap))
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"prev_{f}").alias("before"), F.col(f).alias("after")) for f in ("kills", "deaths")])).alias("x")
    skull = (F.coalesce("gutter", F.lit("")) == "skull") | (F.coalesce("prev_gutter", F.lit("")) == "skull")
    out = prev.select("vod", F.col("name").alias("player"), fields, F.col("prev_end_t").alias("earliest"), F.col("start_t").alias("latest"), skull.alias("skull"))
    return out.where(F.col("x.after") == F.col("x.before") + 1).select("vod", "player", "x.field", "x.before", "x.after", "earliest", "latest", "skull")


def kill_checks(box: DataFrame, team: int = 4) -> DataFrame:
    """(vod, map, name, passed, others) of box scores (vod, map, slot 1-8, kills,
    deaths): a side's kills never exceed the other's deaths."""
    side = F.when(F.col("slot") <= team, "left").otherwise("right")
    total = box.withColumn("side", side).groupBy("vod", "map").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for s in ("left", "right") for c in ("kills", "deaths")],
    )
    one = lambda a, b: F.struct(F.lit(f"{a} kills").alias("name"), ((F.col("rows") == 2 * team) & (F.col(f"{a}_kills") <= F.col(f"{b}_deaths"))).alias("passed"), (F.col(f"{b}_deaths") - F.col(f"{a}_kills")).alias("others"))
    return total.select("vod", "map", F.explode(F.array(one("left", "right"), one("right", "left"))).alias("c")).select("vod", "map", "c.name", "c.passed", "c.others")


#: Seconds within which an increment meets its event.
INCREMENT_WINDOW = 1.5


def localise(steps: DataFrame, events: DataFrame, window: float = INCREMENT_WINDOW) -> DataFrame:
    """(vod, field, player, t, event_t, delta): increments of kills against the
    events of that attacker, of deaths against those of that victim, one-to-one.
    A null event_t is a lost event, a null t an invented one."""
    role = F.explode(F.array(F.struct(F.lit("kills").alias("field"), F.col("attacker").alias("player")), F.struct(F.lit("deaths").alias("field"), F.col("victim").alias("player"))))
    cast = events.select("vod", "t", role.alias("x")).select("vod", "x.field", "x.player", "t").where(F.col("player").isNotNull())
    mine = steps.select("vod", "field", "player", F.col("latest").alias("t"))
    return M.match_both(mine, cast, ["vod", "field", "player"], window)


def localise_report(found: DataFrame) -> DataFrame:
    """(vod, field, increments, matched, lost, invented, median_delta)."""
    both = F.col("t").isNotNull() & F.col("event_t").isNotNull()
    return found.groupBy("vod", "field").agg(
        F.count("t").alias("increments"), F.count_if(both).alias("matched"), F.count_if(F.col("event_t").isNull()).alias("lost"),
        F.count_if(F.col("t").isNull()).alias("invented"), F.median("delta").alias("median_delta"),
    )


def best_of_outliers(header: DataFrame | Header) -> tuple[DataFrame, DataFrame]:
    """((vod, value) by weight of samples, the runs that say otherwise)."""
    runs = Header.of(header).runs.where((F.col("field") == "best_of") & F.col("value").isNotNull())
    mode = A.weighted_mode(runs, VOD, "value", F.col("samples"), F.col("start_t")).drop("weight")
    other = runs.join(mode.withColumnRenamed("value", "_mode"), VOD).where(F.col("value") != F.col("_mode"))
    return mode, other.select(*runs.columns)


def spectated_runs(board: DataFrame) -> DataFrame:
    """Runs in which a slot was the spectated one."""
    return board.where(F.coalesce(F.col("spectated"), F.lit(False)))


def spectated_counts(board: DataFrame, maps: DataFrame, step: float = 1.0) -> DataFrame:
    """(vod, slots, instants): at how many sampled instants of a map how many
    slots were marked spectated; one is right."""
    spans = maps.select("vod", F.col("start_t"), F.col("end_t"))
    at = J.instants(spans, step).select("vod", "t").distinct()
    runs = spectated_runs(board).select("vod", "side", "slot", F.col("start_t").alias("_lo"), F.col("end_t").alias("_hi"))
    met = J.interval_join(at, runs, VOD, "t", "_lo", "_hi").groupBy("vod", "t").agg(F.count_distinct("side", "slot").alias("slots"))
    return at.join(met, ["vod", "t"], "left").groupBy("vod", F.coalesce("slots", F.lit(0)).alias("slots")).agg(F.count(F.lit(1)).alias("instants"))


def in_rounds(events: DataFrame, found: DataFrame) -> DataFrame:
    """Events with the map and round (half-open) that hold them."""
    spans = found.select(*MAP, "number", F.col("start_t").alias("_lo"), F.col("end_t").alias("_hi"))
    return J.interval_join(events, spans, VOD, "t", "_lo", "_hi", closed=False).drop("_lo", "_hi")


def round_checks(found: DataFrame, events: DataFrame, sides: DataFrame, winners: DataFrame, team: int = LIVES) -> DataFrame:
    """(vod, map, check, wrong): how many rounds of a map break each rule: an
    edge seen by all witnesses, an outcome, a winner, no player dead twice, no
    side with more than ``team`` dead; and whether the side with more rounds
    won the map."""
    part = [*MAP, "number"]
    held = in_rounds(events.where(F.col("victim").isNotNull()), found)
    twice = held.groupBy(*part, "victim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).groupBy(*MAP).agg(F.count_distinct("number").alias("twice"))
    named = held.join(sides.select("vod", F.col("name").alias("victim"), "side"), ["vod", "victim"])
    many = named.groupBy(*part, "side").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > team).groupBy(*MAP).agg(F.count_distinct("number").alias("many"))
    edges = (F.col("number") > 1) & (F.size("witnesses") < 3)
    won = lambda side: F.count_if(F.col("winner") == side)
    total = found.groupBy(*MAP).agg(
        F.count_if(edges).alias("unseen"), F.count_if(F.col("outcome").isNull()).alias("open"), F.count_if(F.col("winner").isNull()).alias("undecided"), won("left").alias("l"), won("right").alias("r")
    )
    out = total.join(twice, MAP, "left").join(many, MAP, "left").join(winners.select("vod", F.col("number").alias("map"), F.col("winner").alias("_w")), MAP, "left")
    ahead = F.when(F.col("l") > F.col("r"), "left").when(F.col("r") > F.col("l"), "right")
    checks = {"witnesses": F.col("unseen"), "outcome": F.col("open"), "winner": F.col("undecided"), "one death each": F.col("twice"), "deaths of a side": F.col("many"), "rounds and map": (F.col("_w").isNotNull() & ~ahead.eqNullSafe(F.col("_w"))).cast("bigint")}
    each = [F.struct(F.lit(k).alias("check"), F.coalesce(v.cast("bigint"), F.lit(0)).alias("wrong")) for k, v in checks.items()]
    return out.select(*MAP, F.explode(F.array(*each)).alias("c")).select(*MAP, "c.*")


def margin_checks(box: DataFrame, floor: int = 8) -> DataFrame:
    """Box rows whose least glyph margin lies below the floor."""
    return box.where(F.col("min_margin") < floor)


def anchor_checks(segments: DataFrame, anchors: DataFrame, states: tuple[str, ...] = ("boxscore", "series")) -> DataFrame:
    """(vod, t, state, ok): whether each known instant lies in a segment of one
    of ``states``."""
    runs = segments.select("vod", "start_t", "end_t", "state")
    found = J.value_at(anchors, runs, VOD, "t", ["state"], closed=False)
    return found.withColumn("ok", F.coalesce(F.col("state").isin(*states), F.lit(False)))
