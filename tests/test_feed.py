"""Rows to events, votes of neighbours, calibration, checks and telemetry."""

import random
from collections import Counter

import numpy as np
import pytest

from timeline_engine.functions import bitmaps as B
from timeline_engine.operators import feed as E
from timeline_engine.operators import matching as M
from timeline_engine.plans import segments as G

RNG = np.random.default_rng(8)
NAMES = {n: [RNG.random((14, 40 + 6 * k)) > 0.5] for k, n in enumerate(("ann", "bob", "cyd", "dee"))}
TEAMS = {"ann": "x", "bob": "x", "cyd": "y", "dee": "y"}
ROWS = "vod string, t double, slot int, signature array<int>, x array<int>, attacker_bmp struct<h:int,w:int,b:string>, victim_bmp struct<h:int,w:int,b:string>, medal_bmp struct<h:int,w:int,b:string>"


def noisy(name, share):
    m = NAMES[name][0]
    return B.pack(m ^ (RNG.random(m.shape) < share))


def row(t, slot, a, v, share=0.0, medal=False):
    w = [NAMES[n][0].shape[1] for n in (a, v)]
    return ("v", float(t), slot, [w[0], 48, w[1]], [5, 5 + w[0] + 10, w[0] + 73], noisy(a, share), noisy(v, share), noisy(a, 0) if medal else None)


def test_rows_to_events(spark):
    rows = [row(10, 569, "ann", "cyd", 0.12), row(11, 569, "ann", "cyd", 0.12, medal=True), row(12, 539, "ann", "cyd", 0.12), row(12, 569, "bob", "dee"), row(30, 569, "ann", "bob"), row(40, 569, "ann", "cyd"), row(60, 509, "ann", "cyd", 0.4)]
    df = spark.createDataFrame(rows, ROWS)
    got = E.feed_events(df, ["vod"], NAMES, TEAMS).orderBy("t", "attacker").collect()
    assert [(r.t, r.attacker, r.victim, r.medal, r.frames, r.slots, r.same_team) for r in got] == [
        (10.0, "ann", "cyd", True, 3, [569, 569, 539], False), (12.0, "bob", "dee", False, 1, [569], False), (30.0, "ann", "bob", False, 1, [569], True),
        (40.0, "ann", "cyd", False, 1, [569], False), (60.0, None, None, False, 1, [509], False),
    ]
    assert E.resolved(E.feed_events(df, ["vod"], NAMES, TEAMS)).count() == 4
    dense = E.build_events(df, ["vod"], NAMES, TEAMS, "dense")
    assert dense.count() == 0  # fewer frames than it needs
    read = {(r.t, r.slot): (r.attacker, r.victim, r.resolved) for r in E.read_rows(df, NAMES, TEAMS).collect()}
    assert read[12.0, 569] == ("bob", "dee", True) and len(read) == len(rows)
    cross = E.build_events(df.where("t = 30"), ["vod"], NAMES, TEAMS, "sparse", cross_team=True).first()
    assert not cross.same_team


def vote_brute(rows, votes):
    out = {}
    for t, slot, sig in rows:
        for role in ("attacker", "victim"):
            pool = Counter()
            for (tt, ss, r), given in votes.items():
                other = next(x for x in rows if x[:2] == (tt, ss))
                d = tt - t
                near = abs(d) in (1, 2, 3) and other[2] == sig and (ss <= slot if d < 0 else ss >= slot)
                if r == role and ((tt, ss) == (t, slot) or near):
                    for player, w in given.items():
                        pool[player] += w * (1 if (tt, ss) == (t, slot) else 0.5)
            if pool:
                best = min(pool, key=lambda p: (-pool[p], p))
                out[t, slot, role] = (best, round(pool[best] / sum(pool.values()), 3))
    return out


def test_votes_of_neighbours(spark):
    rng = random.Random(3)
    rows = [(float(t), s, (rng.choice([40, 41]), 48)) for t in range(40) for s in rng.sample([569, 539, 509], rng.randint(0, 3))]
    votes = {(t, s, role): {p: float(rng.randint(1, 4)) for p in rng.sample(["a", "b", "c"], rng.randint(0, 2))} for t, s, _ in rows for role in ("attacker", "victim")}
    df = spark.createDataFrame([("v", t, s, list(g)) for t, s, g in rows], "vod string, t double, slot int, signature array<int>")
    cast = spark.createDataFrame([("v", t, s, role, p, w) for (t, s, role), g in votes.items() for p, w in g.items()], "vod string, t double, slot int, role string, player string, weight double")
    got = {(r.t, r.slot, r.role): (r.label, pytest.approx(r.agreement, abs=1e-3)) for r in E.neighbour_votes(df, cast, ["vod"]).collect()}
    assert got == vote_brute(rows, votes)


def both_brute(steps, events, window):
    found = sorted((abs(e - s), e - s, i, j) for i, s in enumerate(steps) for j, e in enumerate(events) if abs(e - s) <= window)
    mine, theirs = {}, set()
    for _, _, i, j in found:
        if i not in mine and j not in theirs:
            mine[i] = j
            theirs.add(j)
    return sorted([(s, events[mine[i]] if i in mine else None) for i, s in enumerate(steps)] + [(None, e) for j, e in enumerate(events) if j not in theirs], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_steps_and_events(spark, seed):
    rng = random.Random(seed)
    steps, events = (sorted(rng.randint(0, 200) / 2 for _ in range(60)) for _ in "ab")
    a, b = (spark.createDataFrame([("v", t) for t in x], "vod string, t double") for x in (steps, events))
    got = sorted(((r.t, r.event_t) for r in M.match_both(a, b, ["vod"], 1.5).collect()), key=str)
    assert got == both_brute(steps, events, 1.5)


def test_localise(spark):
    steps = spark.createDataFrame([("v", "ann", "kills", 10.0), ("v", "cyd", "deaths", 10.2), ("v", "ann", "kills", 50.0)], "vod string, player string, field string, latest double")
    events = spark.createDataFrame([("v", 10.5, "ann", "cyd"), ("v", 80.0, "ann", None)], "vod string, t double, attacker string, victim string")
    report = {r.field: (r.increments, r.matched, r.lost, r.invented) for r in G.localise_report(G.localise(steps, events)).collect()}
    assert report == {"kills": (2, 1, 1, 1), "deaths": (1, 1, 0, 0)}


def test_templates_and_digits(spark):
    rows = [("ann", *noisy("ann", 0.1)) for _ in range(9)] + [("bob", *noisy("bob", 0.0)) for _ in range(2)] + [("ann", *noisy("dee", 0.0)) for _ in range(3)]
    made = E.majority_templates(spark.createDataFrame(rows, "label string, h int, w int, b string"), ["label"]).orderBy("variant").collect()
    assert [(r.label, r.variant, r.n) for r in made] == [("ann", 0, 9), ("ann", 1, 3)] and (B.unpack(made[0].h, made[0].w, made[0].b) != NAMES["ann"][0]).mean() < 0.02
    assert E.single_path({3: 1, 1: 2}, 3) == [3, 1, 2] and E.single_path({3: 1, 1: 3}, 2) is None and E.single_path({3: 1}, 3) is None
    glyphs = [4, 7, 1, 0, 9, 2, 8, 3, 6, 5]
    series = [("c", float(t), glyphs[t % 10]) for t in range(60)] + [("bad", float(t), t % 2) for t in range(9)]
    got = E.digits_of_counter(spark.createDataFrame(series, "k string, t double, g int"), ["k"], "t", "g")
    assert [(r.k, r.g) for r in got.orderBy("digit").collect()] == [("c", g) for g in glyphs]


def test_parts_and_checks(spark):
    events = spark.createDataFrame([("v", 1, 1, 5.0, "ann", "cyd"), ("v", 1, 1, 7.0, "cyd", "ann"), ("v", 1, 1, 9.0, "bob", "cyd"), ("v", 1, 2, 25.0, None, "dee")], "vod string, map int, number int, t double, attacker string, victim string")
    assert [tuple(r) for r in E.first_of(events, ["vod", "map", "number"]).orderBy("number").collect()] == [("v", 1, 1, 5.0, "ann", "cyd"), ("v", 1, 2, 25.0, None, "dee")]
    sides = spark.createDataFrame([("v", n, "left" if s == "x" else "right") for n, s in TEAMS.items()], "vod string, name string, side string")
    lost = {(r.number, r.side): r.victims for r in E.victims_of_side(events, ["vod", "map", "number"], sides).collect()}
    assert lost == {(1, "left"): ["ann"], (1, "right"): ["cyd", "cyd"], (2, "right"): ["dee"]}
    rounds = spark.createDataFrame([("v", 1, 1, 0.0, 20.0, ["map_start"], "left", "wipe"), ("v", 1, 2, 20.0, 40.0, ["clock_reset", "lives_reset"], None, None)], "vod string, map int, number int, start_t double, end_t double, witnesses array<string>, winner string, outcome string")
    winners = spark.createDataFrame([("v", 1, "right")], "vod string, number int, winner string")
    wrong = {r.check: r.wrong for r in G.round_checks(rounds, events.select("vod", "t", "attacker", "victim"), sides, winners, team=1).collect()}
    assert wrong == {"witnesses": 1, "outcome": 1, "winner": 1, "one death each": 1, "deaths of a side": 1, "rounds and map": 1}
    board = spark.createDataFrame([("v", "left", k, 0.0, 9.0 - k, k < 2) for k in range(4)], "vod string, side string, slot int, start_t double, end_t double, spectated boolean")
    maps = spark.createDataFrame([("v", 0.0, 10.0)], "vod string, start_t double, end_t double")
    assert {r.slots: r.instants for r in G.spectated_counts(board, maps).collect()} == {2: 9, 1: 1, 0: 1}
    runs = spark.createDataFrame([("v", "best_of", b, float(k), k + 1.0, n) for k, (b, n) in enumerate((("9", 50), ("7", 3), (None, 90)))], "vod string, field string, value string, start_t double, end_t double, samples bigint")
    mode, other = G.best_of_outliers(runs)
    assert mode.first().value == "9" and [r.value for r in other.collect()] == ["7"]
    segments = spark.createDataFrame([("v", 0.0, 5.0, "live"), ("v", 5.0, 9.0, "boxscore")], "vod string, start_t double, end_t double, state string")
    anchors = spark.createDataFrame([("v", 2.0), ("v", 5.0), ("v", 9.0)], "vod string, t double")
    assert sorted((r.t, r.state, r.ok) for r in G.anchor_checks(segments, anchors).collect() if r.state) == [(2.0, "live", False), (5.0, "boxscore", True)]
    assert G.margin_checks(spark.createDataFrame([(7,), (8,)], "min_margin int")).count() == 1
