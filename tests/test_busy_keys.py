"""Long keys: linear folds, and ranges with a carry."""

import random
import time

import pytest
from pyspark.sql import functions as F

from timeline_engine.operators import matching as M
from timeline_engine.operators import runs as R
from timeline_engine.operators import segmented
from timeline_engine.operators import sequences as S
from timeline_engine.operators import temporal_joins as J


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one_key(spark, n, seed=1):
    rng = random.Random(seed)
    made = [("a", float(t), rng.choice([None, 1, 2])) for t in range(n)] + [("b", 5.0, 1), ("b", 6.0, 1), ("c", 0.0, None), (None, 1.0, 2), (None, 9.0, 2)]
    return spark.createDataFrame(made, "key string, t double, v int")


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_islands_in_ranges_equal_a_window(spark, parts):
    df = one_key(spark, 500)
    args = (["key"], ["t"], ["v"])
    assert rows(R.islands(df, *args, parts=parts)) == rows(R.islands(df, *args))
    gaps = df.where(F.pmod(F.xxhash64("t"), F.lit(3)) > 0)
    assert rows(R.run_lengths(gaps, *args, "t", 1.0, parts=parts)) == rows(R.run_lengths(gaps, *args, "t", 1.0))
    assert rows(R.islands(df, [], ["key", "t"], ["v"], parts=parts)) == rows(R.islands(df, [], ["key", "t"], ["v"]))
    assert rows(R.islands(df.limit(0), *args, parts=parts)) == []


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_in_ranges_equals_a_window(spark, forward, strict):
    df = one_key(spark, 400)
    right = df.where(F.pmod(F.xxhash64("t"), F.lit(20)) == 0).select("key", F.col("t").alias("at"), "v")
    for r in (right, right.limit(0)):
        args = (df.select("key", "t"), r, ["key"], "t", "at", ["at", "v"], forward, strict, ["v"])
        assert rows(J.asof(*args, parts=12)) == rows(J.asof(*args))


def test_no_range_holds_a_large_share(spark):
    df = one_key(spark, 20_000)
    sizes = [r["count"] for r in segmented.ranges(df, ["key"], ["t"], 16).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * df.count() / 16
    alike = spark.range(8_000).select(F.lit("k").alias("key"), F.lit(1.0).alias("t"), "id")
    sizes = [r["count"] for r in segmented.ranges(alike, ["key"], ["t", "id"], 8).groupBy("_part").count().collect()]
    assert max(sizes) < 2_000


def test_chains_and_matches_in_ranges(spark):
    rng = random.Random(3)
    seen = [("a", float(rng.randrange(3_000)), rng.randrange(5), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(seen, "key string, t double, slot int, f double")
    one = S.chain_events(df, ["key"], "t", "slot", ["f"], 4.0, 0.5, ["f"])
    assert rows(S.chain_events(df, ["key"], "t", "slot", ["f"], 4.0, 0.5, ["f"], parts=9)) == rows(one)
    a, b = df.select("key", "t").distinct(), df.select("key", (F.col("t") + 0.3).alias("t")).distinct()
    assert rows(M.match_events(a, b, ["key"], 1.0, parts=7)) == rows(M.match_events(a, b, ["key"], 1.0))
    assert rows(M.match_both(a, b, ["key"], 1.0, parts=7)) == rows(M.match_both(a, b, ["key"], 1.0))
    seen = df.select("key", "t", F.col("slot").cast("string").alias("name"), (F.col("slot") % 3).alias("rank"))
    for once in (False, True):
        args = (seen, ["key"], "t", "name", "rank", 3.0, 2, once)
        assert rows(S.consensus(*args, parts=5)) == rows(S.consensus(*args))


def slow_absorb(states, starts, ends, samples, interval, dwell):
    found = list(zip(states, starts, ends, samples, strict=True))
    while len(found) > 1:
        lengths = [end - start for _, start, end, _ in found]
        short = [(lengths[i] + interval, i) for i, r in enumerate(found) if lengths[i] + interval < dwell.get(r[0], 0.0)]
        if not short:
            break
        i = min(short)[1]
        into = i + 1 if i == 0 or (i + 1 < len(found) and lengths[i + 1] > lengths[i - 1]) else i - 1
        state = found[into][0]
        a = i - 1 if i > 0 and found[i - 1][0] == state else i
        b = i + 1 if i + 1 < len(found) and found[i + 1][0] == state else i
        found[a : b + 1] = [(state, found[a][1], found[b][2], sum(r[3] for r in found[a : b + 1]))]
    return found


def test_absorbing_equals_the_plain_rule():
    rng = random.Random(8)
    for _ in range(300):
        t, states, starts, ends = 0.0, [], [], []
        for _ in range(rng.randrange(1, 40)):
            states.append(rng.choice([s for s in "abcd" if not states or s != states[-1]]))
            starts.append(t)
            t += rng.randrange(0, 6)
            ends.append(t)
            t += 1
        args = (states, starts, ends, [1] * len(states), 1.0, {"a": 3.0, "b": 5.0, "c": 0.0, "d": rng.choice([2.0, 9.0])})
        assert R.absorb_short(*args) == slow_absorb(*args)


def slow_boundaries(found, tolerance, once):
    made = []
    for _, t, name in sorted(found):
        for b in made:
            if abs(b[0] - t) <= tolerance and not (once and name in b[1]):
                b[1].add(name)
                break
        else:
            made.append((t, {name}))
    return made


def test_boundaries_equal_the_plain_rule():
    rng = random.Random(9)
    for once in (False, True):
        for _ in range(200):
            found = [(rng.randrange(3), float(rng.randrange(60)), rng.choice("xyz")) for _ in range(rng.randrange(1, 50))]
            assert S.joined_boundaries(found, 3.0, once) == slow_boundaries(found, 3.0, once)


def test_long_keys_take_seconds(spark):
    n, rng = 200_000, random.Random(2)
    took = {}

    def timed(name, job):
        began = time.time()
        out = job()
        took[name] = time.time() - began
        return out

    states = [("a", "b", "c")[k % 3] for k in range(n)]
    ends = [3.0 * k + rng.randrange(3) for k in range(n)]
    found = timed("absorb", lambda: R.absorb_short(states, [3.0 * k for k in range(n)], ends, [1] * n, 1.0, {"a": 3.0, "b": 9.0, "c": 2.0}))
    assert sum(r[3] for r in found) == n
    seen = [(k % 3, float(rng.randrange(4 * n)), "xyz"[k % 3]) for k in range(n)]
    assert timed("boundaries", lambda: S.joined_boundaries(seen, 2.0, True))
    df = spark.range(n).select(F.lit("k").alias("key"), F.col("id").cast("double").alias("t"), F.floor(F.rand(1) * 5).alias("l"), (F.col("id") % 7).alias("r"), F.col("id").alias("z"))
    steps = timed("staircase", lambda: S.staircase(df, ["key"], ["t"], "l", "r", "t", "z").collect())
    assert all(x.l <= y.l and x.r <= y.r for x, y in zip(steps, steps[1:], strict=False))
    assert max(took.values()) < 20, took


def test_next_rows_despite_an_outlier(spark):
    t = [float(k) for k in range(3_000)] + [1e12, None]
    df = spark.createDataFrame([(x, k) for k, x in enumerate(t)], "t double, k int")
    got = {r.k: r.next_t for r in S.with_next(df, "t", ["t"], per_block=100).collect()}
    assert all(got[k] == t[k + 1] for k in range(3_000)) and got[3_000] is None and got[3_001] is None and len(got) == len(t)
    assert {r.k: r.next_t for r in S.with_next(df, "t", ["t"]).collect()} == got
