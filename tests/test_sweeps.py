"""Grids of settings and names of clusters against plain versions."""

import random
from collections import Counter, defaultdict
from statistics import median

from timeline_engine.operators import naming as N
from timeline_engine.operators import sequences as S
from timeline_engine.operators import sweeps as W


def test_grid_equals_one_chaining_per_setting(spark):
    rng = random.Random(4)
    seen = [(key, float(rng.randrange(120)), rng.randrange(4), rng.randrange(6), rng.randrange(6), n) for n, key in enumerate(rng.choices("ab", k=160))]
    df = spark.createDataFrame(seen, "key string, t double, slot int, f int, g int, n int").repartition(3)
    features = {"one": ["f"], "two": ["f", "g"]}
    got = {tuple(r)[:5]: r.events for r in W.chain_grid(df, ["key"], "t", "slot", features, [2.0, 5.0], [0, 2], [1, 3], ["n"]).collect()}
    want = {}
    for key in "ab":
        rows = sorted((t, slot, n, (f, g)) for k, t, slot, f, g, n in seen if k == key)
        for name, wide in (("one", 1), ("two", 2)):
            for gap in (2.0, 5.0):
                for slack in (0, 2):
                    sizes = [len(c) for c in S.chains([(t, slot, x[:wide]) for t, slot, _, x in rows], gap, slack)]
                    for least in (1, 3):
                        want[(key, name, gap, float(slack), least)] = sum(x >= least for x in sizes)
    assert got == want


def test_scores_count_keys_on_either_side(spark):
    counts = spark.createDataFrame([("a", "f", 1.0, 1.0, 1, 5), ("b", "f", 1.0, 1.0, 1, 2), ("a", "f", 2.0, 1.0, 1, 3)], "key string, features string, max_gap double, slack double, min_frames int, events bigint")
    expected = spark.createDataFrame([("a", 3), ("c", 4)], "key string, n bigint")
    got = {r.max_gap: (r.events, r.error, r.excess, r.best) for r in W.grid_scores(counts, expected, ["key"], "n").collect()}
    assert got == {1.0: (7, 2 + 2 + 4, 4, False), 2.0: (3, 4, 0, True)}


def test_values_of_several_series(spark):
    rng = random.Random(6)

    def runs(n):
        out, t = [], 0.0
        for k in range(n):
            t += rng.randrange(1, 5)
            end = t + rng.randrange(0, 4)
            out.append(("k", t, end, rng.choice([None, f"v{k}"])))
            t = end + 1
        return out

    a, b = runs(30), runs(20)
    schema = "key string, start_t double, end_t double, value string"
    left = spark.createDataFrame([("k", x / 2) for x in range(300)] + [("z", 3.0)], "key string, t double")
    got = N.values_at(left, {"x": spark.createDataFrame(a, schema), "y": spark.createDataFrame(b, schema)}, ["key"], "t").collect()
    at = lambda series, key, t: next((v for k, s, e, v in series if k == key and s <= t <= e), None)
    assert len(got) == 301 and all((r.x, r.y) == (at(a, r.key, r.t), at(b, r.key, r.t)) for r in got)


def test_cluster_names_equal_a_plain_rule(spark):
    rng = random.Random(7)
    votes = []
    for n in range(1500):
        icon = rng.choice("ABCD")
        gun = rng.choice({"A": ["m4", "m4", "rifle"], "B": ["smg", "smg", "m4"], "C": ["bow", "axe"], "D": ["pan"]}[icon])
        votes.append((icon, gun, round(rng.choice([0.1, 0.12, 0.2]), 3), n))
    df = spark.createDataFrame(votes, "icon string, gun string, d double, n int")
    per, first = defaultdict(lambda: defaultdict(list)), {}
    for icon, gun, d, n in votes:
        per[icon][gun].append(d)
        first.setdefault((icon, gun), n)
    top = {icon: min(guns, key=lambda g: (-len(guns[g]), first[icon, g])) for icon, guns in per.items()}
    want = {}
    for icon, guns in per.items():
        best = median(guns[top[icon]])
        held = [g for g, d in guns.items() if g == top[icon] or (abs(median(d) - best) <= 0.02 and len(d) >= 20 and g not in top.values())]
        want[icon] = (" / ".join(sorted(held)), top[icon], len(guns[top[icon]]), sum(map(len, guns.values())))
    got = {r.icon: (r.label, r.winner, r.led, r.pairings) for r in N.cluster_names(df, "icon", "gun", "d", ["n"]).collect()}
    assert got == want and Counter(v[0] for v in got.values())


def test_panel_runs_equal_a_plain_walk(spark):
    from timeline_engine.operators import panels as P

    rng = random.Random(9)
    rows = [(key, float(t), rng.random() < 0.8, rng.choice([True, True, True, False, None]), rng.choice([None, 1, 2]), rng.choice(["x", "y", None])) for key in "ab" for t in range(150)]
    df = spark.createDataFrame(rows, "key string, t double, live boolean, drawn boolean, hp int, name string").repartition(3)
    runs, counts = P.panel_runs(df, ["key"], ["t"], "t", ["hp", "name"], "live", "drawn")
    want, n = [], Counter()
    for key in "ab":
        open_ = {}
        for k, t, live, drawn, hp, name in rows:
            if k != key:
                continue
            n[key, "live"] += live
            if not live or not drawn:
                want += open_.values()
                open_ = {}
                continue
            n[key, "drawn"] += 1
            for f, v in (("hp", None if hp is None else str(hp)), ("name", name)):
                n[key, f"unread {f}"] += v is None
                if f in open_ and open_[f][2] == v:
                    open_[f] = (*open_[f][:4], t, open_[f][5] + 1)
                else:
                    want += [open_[f]] if f in open_ else []
                    open_[f] = (key, f, v, t, t, 1)
        want += open_.values()
    assert sorted(map(tuple, runs.collect()), key=str) == sorted(want, key=str)
    assert {(r.key, r.what): r.n for r in counts.collect()} == dict(n)
