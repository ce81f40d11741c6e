"""The engine's operators against independent plain-Python versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeline_engine.functions import bitmaps as B
from timeline_engine.functions import exprs as X
from timeline_engine.operators import aggregates as A
from timeline_engine.operators import clustering as C
from timeline_engine.operators import matching as M
from timeline_engine.operators import runs as R
from timeline_engine.operators import sequences as S
from timeline_engine.operators import temporal_joins as J

STATES = {"l": "live", "r": "replay", "b": "boxscore", "s": "series", "o": "other"}


def observations(spark, texts):
    rows = [(k, float(t), STATES[c]) for k, text in enumerate(texts) for t, c in enumerate(text)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "vod int, t double, state string")


def smooth_plain(text):
    """The smoothing rules, one step at a time, on a list of [state, t0, t1, n]."""

    def joined(runs):
        out = []
        for r in runs:
            if out and out[-1][0] == r[0]:
                out[-1] = [r[0], out[-1][1], r[2], out[-1][3] + r[3]]
            else:
                out.append(list(r))
        return out

    runs = joined([[STATES[c], float(t), float(t), 1] for t, c in enumerate(text)])
    step = 1.0
    again = True
    while again:
        again = False
        for i in range(1, len(runs) - 1):
            if runs[i][0] != "replay" and runs[i - 1][0] == runs[i + 1][0] == "replay" and runs[i][2] - runs[i][1] + step <= 4:
                runs[i][0], again = "replay", True
                runs = joined(runs)
                break
    while len(runs) > 1:
        short = [(r[2] - r[1] + step, i) for i, r in enumerate(runs) if r[2] - r[1] + step < R.LEAST_DWELL[r[0]]]
        if not short:
            break
        i = min(short)[1]
        near = [(-(runs[k][2] - runs[k][1]), k) for k in (i - 1, i + 1) if 0 <= k < len(runs)]
        runs[i][0] = runs[min(near)[1]][0]
        runs = joined(runs)
    return [(r[0], r[1], r[2] + step, r[3]) for r in runs]


def test_smoothing(spark):
    rng = random.Random(3)
    texts = ["l" * 10 + "o" + "l" * 10, "l" * 10 + "ooo" + "l" * 10, "l" * 10 + "r" + "l" * 10, "rr" + "ll" + "rr" + "l" * 9, "o", "lo", "s" * 7 + "l" * 9, "b" * 4 + "l" * 4]
    texts += ["".join(rng.choice("llllrrbso") * rng.randint(1, 7) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    out = R.smooth(observations(spark, texts), ["vod"], ["t"], "state", "t")
    got = {}
    for r in out.orderBy("vod", "start_t").collect():
        got.setdefault(r.vod, []).append((r.state, r.start_t, r.end_t, r.samples))
    assert got == {k: smooth_plain(t) for k, t in enumerate(texts)}
    assert got[0] == [("live", 0.0, 21.0, 21)] and len(got[1]) == 3 and [s[0] for s in got[2]] == ["live", "replay", "live"]


def test_stitch_equals_unchunked(spark):
    rng = random.Random(5)
    rows, t = [], 0.0
    for _ in range(800):
        t += rng.choice([0.1, 0.1, 0.1, 1.0])
        rows.append((1, round(t, 3), rng.choice([None, "a", "a", "b"]), int(t // 9)))
    df = spark.createDataFrame(rows, "k int, t double, v string, chunk int")
    whole = R.run_lengths(df, ["k"], ["t"], ["v"], "t", max_gap=0.2).select("v", "start_t", "end_t", "samples")
    parts = R.stitch(R.run_lengths(df, ["k", "chunk"], ["t"], ["v"], "t", max_gap=0.2), ["k"], ["v"], 0.2 + 1e-9).select("v", "start_t", "end_t", "samples")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, parts.collect()), key=str)


def chain_plain(rows, max_gap, slack):
    done, open_ = [], []
    for t in sorted({r[0] for r in rows}):
        for c in list(open_):
            if t - rows[c[-1]][0] > max_gap:
                open_.remove(c)
                done.append(c)
        taken = []
        for i, r in sorted(((i, r) for i, r in enumerate(rows) if r[0] == t), key=lambda x: x[1][1]):
            fit = [c for c in open_ if c not in taken and rows[c[-1]][1] >= r[1] and rows[c[-1]][0] < t and abs(rows[c[-1]][2] - r[2]) <= slack]
            if fit:
                c = min(fit, key=lambda c: rows[c[-1]][1])
                c.append(i)
            else:
                c = [i]
                open_.append(c)
            taken.append(c)
    return sorted(sorted(rows[i] for i in c) for c in done + open_)


@pytest.mark.parametrize("seed", range(4))
def test_chaining(spark, seed):
    rng, rows, t = random.Random(seed), [], 0.0
    for _ in range(200):
        t += rng.choice([1.0, 1.0, 1.0, 2.0, 6.0, 6.5, 9.0])
        for slot in sorted(rng.sample([569, 539, 509, 479, 449], rng.randint(1, 4))):
            rows.append((t, slot, rng.choice([20, 22, 30, 60])))
    df = spark.createDataFrame([(1, *r) for r in rows], "vod int, t double, slot int, width int")
    out = S.chain_events(df, ["vod"], "t", "slot", ["width"], max_gap=6.0, slack=3.0).collect()
    got = {}
    for r in out:
        got.setdefault((r.session, r.chain), []).append((r.t, r.slot, r.width))
    assert sorted(map(sorted, got.values())) == chain_plain(rows, 6.0, 3.0)


def test_chain_scenarios(spark):
    cases = {
        "persists": ([(0, 569), (1, 569), (2, 569)], 1),
        "two slots": ([(0, 569), (0, 539)], 2),
        "moves up": ([(0, 569), (1, 539)], 1),
        "moves down": ([(0, 539), (1, 569)], 2),
        "long gap": ([(0, 569), (7, 569)], 2),
        "gap of six": ([(0, 569), (6, 569)], 1),
        "dropped frame": ([(0, 569), (2, 569)], 1),
    }
    rows = [(name, float(t), s, "a", s == 569 and t == 1) for name, (seen, _) in cases.items() for t, s in seen]
    df = spark.createDataFrame(rows, "name string, t double, slot int, who string, medal boolean")
    out = S.chain_summary(S.chain_events(df, ["name"], "t", "slot"), ["name"], "t", "slot", ["who"], ["medal"])
    n = Counter(r.name for r in out.collect())
    assert n == {name: want for name, (_, want) in cases.items()}
    first = out.where("name = 'persists'").first()
    assert (first.t, first.frames, list(first.slots), first.medal) == (0.0, 3, [569, 569, 569], True)


def greedy_plain(a, b, window, offset):
    left = sorted((abs(y - (x + offset)), i, j) for i, x in enumerate(a) for j, y in enumerate(b) if abs(y - (x + offset)) <= window)
    out = {}
    for _, i, j in left:
        if i not in out and j not in out.values():
            out[i] = j
    return out


def test_greedy_matching(spark):
    rng = random.Random(8)
    falls = [(k, round(rng.uniform(0, 60), 2)) for k in "abc" for _ in range(40)]
    events = [(k, round(rng.uniform(0, 60), 2)) for k in "abd" for _ in range(30)]
    out = M.match_events(spark.createDataFrame(falls, "k string, t double"), spark.createDataFrame(events, "k string, t double"), ["k"], 0.7, 0.2).collect()
    assert len(out) == len(falls)
    for k in "abc":
        a, b = sorted(t for x, t in falls if x == k), sorted({t for x, t in events if x == k})
        want = greedy_plain(a, b, 0.7, 0.2)
        got = sorted((r.t, r.matched_t) for r in out if r.k == k and r.matched_t is not None)
        assert got == sorted((a[i], b[j]) for i, j in want.items())


def test_staircase(spark):
    rng = random.Random(2)
    rows = [(v, float(t), rng.randint(0, 3), rng.randint(0, 3), float(t) + 0.5) for v in range(6) for t in range(40)]
    df = spark.createDataFrame(rows, "vod int, start_t double, l int, r int, end_t double")
    got = {}
    for r in S.staircase(df, ["vod"], ["start_t"], "l", "r").orderBy("vod", "start_t").collect():
        got.setdefault(r.vod, []).append((r.l, r.r, r.start_t, r.end_t))
    for v in range(6):
        out = []
        for _, t, a, b, e in (r for r in rows if r[0] == v):
            if out and (a < out[-1][0] or b < out[-1][1]):
                continue
            if out and out[-1][:2] == (a, b):
                out[-1] = (a, b, out[-1][2], max(out[-1][3], e))
            else:
                out.append((a, b, t, e))
        assert got[v] == out


@pytest.mark.parametrize("once", [False, True])
def test_consensus(spark, once):
    rng = random.Random(6)
    rows = [(v, rng.randint(0, 120) / 2, n, k) for v in range(8) for k, n in enumerate("abc") for _ in range(rng.randint(0, 7))]
    out = S.consensus(spark.createDataFrame(rows, "vod int, t double, name string, rank int"), ["vod"], "t", "name", "rank", 3.0, 3, once).collect()
    for v in {r[0] for r in rows}:
        found = []
        for _, t, n, _ in sorted((r for r in rows if r[0] == v), key=lambda r: (r[3], r[1])):
            hit = next((b for b in found if abs(b[0] - t) <= 3.0 and not (once and n in b[1])), None)
            if hit is None:
                hit = [t, {}]
                found.append(hit)
            hit[1][n] = t
        assert sorted((r.t, sorted(r.witnesses), r.confirmed) for r in out if r.vod == v) == sorted((t, sorted(w), len(w) == 3) for t, w in found)


def test_asof_ties_and_nulls(spark):
    left = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 5.0), (2, 3.0), (3, 0.0)], "k int, t double")
    right = spark.createDataFrame([(1, 2.0, "a"), (1, 2.0, "b"), (1, 4.0, None), (2, 9.0, "z")], "k int, u double, v string")
    get = lambda **kw: {(r.k, r.t): (r.u, r.v) for r in J.asof(left, right, ["k"], "t", "u", ["u", "v"], tie=["v"], **kw).collect()}
    assert get() == {(1, 1.0): (None, None), (1, 2.0): (2.0, "b"), (1, 5.0): (4.0, None), (2, 3.0): (None, None), (3, 0.0): (None, None)}
    assert get(strict=True)[(1, 2.0)] == (None, None)
    assert get(forward=True) == {(1, 1.0): (2.0, "a"), (1, 2.0): (2.0, "a"), (1, 5.0): (None, None), (2, 3.0): (9.0, "z"), (3, 0.0): (None, None)}
    assert get(forward=True, strict=True)[(1, 2.0)] == (4.0, None)


def test_asof_and_interval_plans(spark):
    """No join in an as-of plan; an equi-join, not a nested loop, for intervals."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", X.seconds(F.col("ts")).alias("t"))
    text = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text(J.asof(e, e.select("user_id", F.col("t").alias("u")), ["user_id"], "t", "u", ["u"]))
    spans = e.select("user_id", F.col("t").alias("start_t"), (F.col("t") + 9).alias("end_t"))
    plan = text(J.interval_join(e, spans, ["user_id"], "t"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_expressions(spark):
    clocks = {"3:43": 223.0, "0:04": 4.0, "28.5": 28.5, "0.0": 0.0, "3:4": None, "343": None, "28.55": None, ".5": None, "": None, "12:345": None, None: None}
    df = spark.createDataFrame([(c,) for c in clocks], "c string")
    assert dict(df.select("c", X.clock_seconds(F.col("c"))).collect()) == clocks
    cells = {"12": True, "3/4": True, "1/2/3": False, "3:15": True, "1:2:3": False, "12.5%": True, "12%": True, "%": False, "": False, "/": False, "-1": False, "1.2.3": False, "7/": True}
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert dict(df.select("c", X.numeric_cell(F.col("c"))).collect()) == cells
    kd = {"3/4": (3, 4), "3-4": (None, None), "1/2/3": (None, None), "/4": (None, None), None: (None, None)}
    df = spark.createDataFrame([(c,) for c in kd], "c string")
    assert {r[0]: (r[1], r[2]) for r in df.select("c", *X.ratio_parts(F.col("c"))).collect()} == kd
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double").select(X.half_even(F.col("x"))).collect()
    assert [r[0] for r in halves] == [0, 2, 2, 0]


def test_weighted_mode_ties(spark):
    rows = [(1, "b", 2, 0.0), (1, "a", 1, 1.0), (1, "a", 1, 2.0), (2, None, 9, 0.0), (2, "x", 1, 5.0)]
    out = A.weighted_mode(spark.createDataFrame(rows, "k int, v string, w int, t double"), ["k"], "v", F.col("w"), F.col("t")).collect()
    assert sorted(map(tuple, out)) == [(1, "b", 2), (2, "x", 1)]


def test_precision_recall(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", None), ("c", "a")]
    out = {r["class"]: (r.tp, r.fp, r.fn) for r in A.precision_recall(spark.createDataFrame(rows, "t string, p string"), "t", "p").collect()}
    assert out == {"a": (1, 1, 1), "b": (1, 1, 1), "c": (0, 0, 1)}


def mask(text):
    return B.from_rows(text.split())


def test_bitmap_kernels():
    a, b = mask("##. #.. ###"), mask("##. ##. ###")
    assert B.unpack(*B.pack(a)).tolist() == a.tolist() and B.to_rows(a) == ["##.", "#..", "###"]
    assert B.normalised_distance(a, a) == 0.0 and B.normalised_distance(mask("#"), mask("#"), 0) == 0.0
    assert B.normalised_distance(mask("#... .... .... ...."), mask(".... .... .... ..#."), 0) == 1.0
    assert B.normalised_distance(mask(". ."), mask(". .")) == 1.0
    assert B.normalised_distance(mask("#.. ... ..."), mask(".#. ... ..."), 1) == 0.0
    assert B.majority([mask("#"), mask("#"), mask(".")]).tolist() == [[True]] and B.majority([mask("#"), mask(".")]).tolist() == [[False]]
    assert B.majority([mask("#"), mask("##")]).shape == (1, 2)
    assert B.modal_majority([mask("#"), mask("##"), mask(".#")]).tolist() == [[False, True]]
    assert B.glyph_spans(mask("#.##..# #.#...#")).tolist() == [[0, 1], [2, 4], [6, 7]]
    assert B.glyph_spans(mask("#.##..#"), 2).tolist() == [[0, 4], [6, 7]]
    assert B.tight(mask("... .#. ...")).tolist() == [[True]] and B.tight(mask("..")).shape == (0, 0)
    assert B.grouped([1, 2, 3, 7, 8, 20], 2) == [(1, 3), (7, 8), (20, 20)] and B.grouped([], 1) == []
    assert B.binarise(np.array([150, 151])).tolist() == [False, True]
    with pytest.raises(ValueError):
        B.majority([])
    with pytest.raises(ValueError):
        B.on_canvas(a, (2, 2))
    with pytest.raises(LookupError):
        B.nearest_template(mask("#" * 30), {"x": mask("#")})


def test_bitmap_matching():
    names = {"a": [mask("##. #.. ###")], "b": [mask("..# ..# ..#")], "c": [mask("### #.# ###")]}
    label, distance, second, other = B.accept(B.rank_names(mask("##. #.. ###"), names))
    assert (label, distance) == ("a", 0.0) and other > distance and second == "c"
    assert B.accept([(0.1, "a"), (0.15, "b")])[0] is None and B.accept([(0.9, "a")])[0] is None and B.accept([(0.3, "a")])[0] == "a"
    first, second = B.accept_pair([(0.1, "a"), (0.3, "b")], [(0.0, "c"), (0.5, "b")], {"a": "x", "c": "x", "b": "y"})
    assert (first[1], second[1]) in {(0.3, 0.0), (0.1, 0.5)} and first[1] + second[1] == 0.3
    assert B.nearest_glyph(mask("#. .#"), {"x": B.on_canvas(mask("#. .#")), "y": B.on_canvas(mask("##"))})[:2] == ("x", 0)
    grey = np.zeros((5, 9), np.uint8)
    grey[1:4, 1:3] = 200
    grey[2, 5:8] = 200
    atlas = {"1": B.on_canvas(np.ones((3, 2), bool)), "-": B.on_canvas(np.ones((1, 3), bool))}
    assert B.read_text(grey, atlas)[0] == "1-"


def test_name_udf(spark):
    names = {"a": [mask("##. #.. ###")], "b": [mask("#.# ... #.#")]}
    rows = [(B.pack(mask("##. #.. ###")),), (B.pack(mask("..... #.#.. ..... #.#..")),), ((0, 0, None),)]
    out = spark.createDataFrame(rows, "m struct<h:int,w:int,b:string>").select(B.name_udf(names)("m").alias("r")).select("r.*").collect()
    assert [r.label for r in out] == ["a", "b", None]


def test_clustering(spark):
    d = np.array([[0, 0.1, 0.9, 0.8], [0.1, 0, 0.9, 0.9], [0.9, 0.9, 0, 0.2], [0.8, 0.9, 0.2, 0]])
    assert C.medoids(d, 0.2) == [[0, 1], [2, 3]] and C.medoids(d, 0.2, recount=True) == [[0, 1], [2], [3]]
    masks = [mask("##. #.. ###")] * 3 + [mask("##. ##. ###")] + [mask("..# ..# ..#")] * 2
    df = spark.createDataFrame([("k", *B.pack(m)) for m in masks], "k string, h int, w int, b string")
    for method in ("medoid", "leader"):
        out = C.cluster_bitmaps(df, ["k"], 0.3, method).collect()
        assert sorted(r.n for r in out) == [1, 2, 3] and len({r.cluster for r in out}) == 2


def test_presets(spark):
    get = lambda ts: S.infer_preset(spark.createDataFrame([(t,) for t in ts], "t double"), "t").first().preset
    assert [get([0.0, 1.0, 2.0]), get([0.0, 0.08, 0.16]), get([0.0, 0.1]), get([59.95, 60.02, 130.0]), get([0.0, 0.5, 1.0])] == ["sparse", "dense", "sparse", "dense", "dense"]
