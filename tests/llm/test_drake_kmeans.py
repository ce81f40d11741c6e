"""Clustering with adaptive bounds against plain rounds of assignment."""

import hashlib
import math
import random

import numpy as np
import pytest

from timeline_engine.llm import drake_kmeans as drake

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, vector string, label int"


def kept(rows, size):
    fine = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda x: max(-drake.MOST, min(drake.MOST, math.floor(256 * x)))
    return [(i, [cut(x) for x in v]) for i, v in fine]


def brute(rows, k, rounds, size, seed):
    vectors = kept(rows, size)
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)[:k]
    c = [list(v) for _, v in starts]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, y, strict=True)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, v in vectors:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            c[j] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in vectors), key=str), c


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "c", "v", 1) for i, v in rows], SCHEMA).repartition(3)
    found, c = drake.cluster(df, **how)
    full = drake.with_inertia(found, c).collect()
    assert len(full) == found.count()
    for r in full:
        assert r.centroid_sha256 == drake.centroid_digest(c[r.cluster])
        assert r.inertia == sum(x.distance for x in full)
        assert r.cluster_inertia == sum(x.distance for x in full if x.cluster == r.cluster)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in full), key=str), c.tolist()


@pytest.mark.parametrize("seed", range(2))
def test_equals_plain_rounds(spark, seed):
    rng = random.Random(seed)
    centre = [[rng.uniform(-2, 2) for _ in range(6)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in rng.choice(centre)]) for i in range(400)]
    rows += [(400 + i, [0.25] * 6) for i in range(150)]  # one vector many times
    rows += [(i, [rng.choice([0.0, 1.0]) for _ in range(6)]) for i in range(600, 700)]  # ties
    how = {"k": 12, "rounds": 5, "size": 6, "seed": 7}
    assert run(spark, rows, **how) == brute(rows, **how)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, 2.0]), (3, [1.0, None, 2.0]), (4, [nan, 0.0, 0.0]), (5, [0.0, -inf, 0.0]), (6, [])]
    rows += [(7, [1e300, -1e300, 0.5]), (8, [-0.001, 0.001, 1e7]), (9, [0.0, 0.0, 0.0]), (9, [0.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [3.0, 3.0, 3.0])]
    for k in (1, 2, 3, 40):
        how = {"k": k, "rounds": 5, "size": 3, "seed": 2}
        assert run(spark, rows, **how) == brute(rows, **how)
    for none in ([], [(1, None)], [(None, [1.0, 1.0, 1.0])]):
        assert run(spark, none, k=4, rounds=2, size=3, seed=2)[0] == []


def test_bounds_certify_most_vectors(monkeypatch):
    """Later rounds measure few vectors against all centroids, and never err."""
    rng = np.random.default_rng(5)
    c = rng.integers(-4000, 4000, (40, 16))
    x = (c[rng.integers(0, 40, 3000)] + rng.integers(-300, 300, (3000, 16))).astype(np.int64)
    state = drake.Bounds.unknown(len(x), 10)
    state.assign(x, c)
    rescanned, plain = [], drake.distances
    monkeypatch.setattr(drake, "distances", lambda a, b: rescanned.append(len(a)) or plain(a, b))
    for step in range(4):
        moved = c + rng.integers(-20, 20, c.shape)
        state.move(np.sqrt(((moved - c) ** 2).sum(1).astype(float)))
        c = moved
        state = state.listing(10 - 2 * step)
        state.assign(x, c)
        d = plain(x, c)
        assert np.array_equal(state.cluster, d.argmin(1))
        assert np.all(state.upper.astype(float) ** 2 >= d.min(1) * (1 - 1e-9))
        others = np.sqrt(np.take_along_axis(d, state.near, 1))
        assert np.all(state.lower <= others + 1e-9)
    assert sum(rescanned) < 0.05 * 4 * len(x)


def test_distances_are_exact_beyond_floats():
    x = np.array([[drake.MOST, -drake.MOST], [1, 2]], np.int64)
    c = np.array([[-drake.MOST, drake.MOST - 1], [0, 0], [3, 5]], np.int64)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in c] for p in x]
    assert drake.distances(x, c).tolist() == want
