"""Readings that vote alike are counted, and no side of the join is sent whole."""

import random
from collections import defaultdict
from difflib import SequenceMatcher

from timeline_engine.operators import fuzzy as Z


def test_equal_readings_are_counted_before_they_meet_names(spark):
    rng = random.Random(5)
    names = ["red bolt", "red bolts", "old ring", "cold ring"]
    texts = ["red blt", "rad bolt", "cold rng", "zzz", "", None]
    rows = [(k % 2, k // 4 if k < 360 else None, rng.choice(texts), rng.choice((0.5, 1.0, None))) for k in range(400)]
    df = spark.createDataFrame(rows, "brand int, part int, text string, confidence double")
    votes = Z.fuzzy_votes(df, spark.createDataFrame([(n,) for n in names], "name string"), ["brand"], ["part"])
    best, want = defaultdict(float), defaultdict(float)
    for brand, part, text, confidence in rows:
        for name in names if text else ():
            ratio = SequenceMatcher(None, text, name, autojunk=False).ratio()
            if ratio >= 0.7:
                best[brand, part, name] = max(best[brand, part, name], ratio * (0.5 + (confidence or 0.0)))
    for (brand, _, name), x in best.items():
        want[brand, name] += x
    assert {(r.brand, r.name): round(r.score, 6) for r in votes.collect()} == {k: round(x, 6) for k, x in want.items()}
    plan = votes._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [text" in plan and "_n" in plan
