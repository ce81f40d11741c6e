"""Fuzzy votes against all pairs."""

import random
from collections import defaultdict
from difflib import SequenceMatcher

from timeline_engine.operators import fuzzy as Z
from timeline_engine.plans import report_queries as R

DIR = "/root/testdata/sf0.001"


def ratio(a, b):
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def test_similar_names_equal_all_pairs(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    texts = [word(rng.randrange(0, 12)) for _ in range(150)] + [None, "", "é" * 7, "a"]
    names = [word(rng.randrange(1, 12)) for _ in range(60)] + [None, "", "éé" * 3]
    t, n = spark.createDataFrame([(x,) for x in texts], "text string"), spark.createDataFrame([(x,) for x in names], "name string")
    for least in (0.7, 1.0, 0.35):
        got = {(r.text, r.name): round(r.ratio, 9) for r in Z.similar_names(t, n, least).collect()}
        want = {(x, y): round(ratio(x, y), 9) for x in set(texts) if x for y in set(names) if y and ratio(x, y) >= least}
        assert got == want


def test_votes_of_the_query_equal_all_pairs(spark):
    readings = R._misread(spark, DIR).collect()
    names = {r.p_name for r in spark.read.parquet(f"{DIR}/part.parquet").collect()}
    known = {(t, n): ratio(t, n) for t in {r.text for r in readings} for n in names}
    best = defaultdict(float)
    for r in readings:
        for n in names:
            if known[r.text, n] >= 0.7:
                best[r.brand, r.p_partkey, n] = max(best[r.brand, r.p_partkey, n], known[r.text, n] * (0.5 + r.confidence))
    score = defaultdict(lambda: defaultdict(float))
    for (brand, _, n), x in best.items():
        score[brand][n] += x
    want = {b: (min(v, key=lambda n: (-round(v[n], 6), n)), len(v)) for b, v in score.items()}
    assert {r.brand: (r.name, r.names) for r in R.fuzzy_names(spark, DIR).collect()} == want
