"""Star contraction with hubs and local batches, and further links, against union-find."""

import random

import numpy as np
import pytest

from timeline_engine.llm import components


def least(links):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {x: find(x) for x in top}


def links_of(seed):
    rng = random.Random(seed)
    n = (30, 200, 400)[seed]
    links = [(rng.randrange(-n, n), rng.randrange(-n, n)) for _ in range(n)]
    links += [(5, x) for x in range(50, 80)] + [(-9, x) for x in range(-80, -40)]  # hubs
    links += [(k, k + 1) for k in range(1000, 1150)] + [(None, 3), (4, None), (4, 4)] + links[:9]
    rng.shuffle(links)
    return links


@pytest.mark.parametrize("seed", range(3))
def test_hubs_and_further_links(spark, monkeypatch, seed):
    monkeypatch.setattr(components, "LOCAL_LINKS", 7)
    monkeypatch.setattr(components, "LEAST_HUB", 3)
    links = links_of(seed)
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(5)
    rows = components.components(frame).collect()
    assert dict(rows) == least(links) and len(rows) == len(least(links))
    half = len(links) // 2
    found = components.components(spark.createDataFrame(links[:half], "a bigint, b bigint"))
    rows = components.joined_components(found, spark.createDataFrame(links[half:], "a bigint, b bigint")).collect()
    assert dict(rows) == least(links) and len(rows) == len(least(links))


def test_no_links(spark):
    none = spark.createDataFrame([], "a bigint, b bigint")
    found = components.components(none)
    assert found.collect() == []
    assert components.joined_components(found, none).collect() == []


def test_local_stars():
    rng = np.random.default_rng(3)
    for size in (1, 5, 60, 400):
        a, b = rng.integers(-90, 90, (2, size))
        node, top = components.stars(a, b)
        want = {x: t for x, t in least(zip(a.tolist(), b.tolist(), strict=True)).items() if x != t}
        assert dict(zip(node.tolist(), top.tolist(), strict=True)) == want
