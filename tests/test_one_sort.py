"""Runs and pair series are read along one sort a side and one for both."""

import random

from pyspark.sql import functions as F

from timeline_engine.operators import runs as R
from timeline_engine.operators import temporal_joins as J
from timeline_engine.plans import join_queries as Q

DIR = "/root/testdata/sf0.001"


def test_run_lengths_equal_numbered_groups(spark):
    rng = random.Random(11)
    rows = [(k, rng.choice((None, 1.0, 2.0, 3.0, 9.0, 10.0)), i, rng.choice(("a", "b", None)), rng.choice((None, 1))) for i in range(400) for k in (rng.choice((None, 1, 2, 3)),)]
    df = spark.createDataFrame([*rows, (8, None, 1000, "a", None), (9, 4.0, 1001, None, None)], "k int, t double, id int, v string, x int")
    for value, gap in ((["v"], None), (["v", "x"], 2.0), ([], 3.0), (["x"], None)):
        numbered = R.islands(df, ["k"], ["t", "id"], value, gap, "t")
        want = numbered.groupBy("k", "run").agg(*[F.first(v).alias(v) for v in value], F.min("t").alias("start_t"), F.max("t").alias("end_t"), F.count(F.lit(1)).alias("samples"))
        got = R.run_lengths(df, ["k"], ["t", "id"], value, "t", gap)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _runs(rng, keys, longest):
    for k in keys:
        t = 0.0
        for _ in range(rng.randrange(0, longest)):
            t += rng.choice((0.0, 1.0, 2.0)) + 1
            end = t + rng.choice((0.0, 1.0, 4.0))
            yield k, t, end, rng.choice(("a", "b", None))
            t = end


def test_pair_series_equals_lookups(spark):
    rng = random.Random(4)
    left, right = (list(_runs(rng, range(6), 30)) for _ in range(2))
    spans = [(k, a, a + rng.choice((5.0, 20.0))) for k in range(5) for a in (0.0, 10.0, 12.0, 60.0)]
    schema = "k int, start_t double, end_t double, v string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    for within in (None, spans):
        want = []
        for k in range(6):
            last = None
            for t in sorted({r[1] for r in left + right if r[0] == k}):
                x, y = ([r for r in side if r[0] == k and r[1] <= t <= r[2] and r[3]] for side in (left, right))
                if not x or not y or within is not None and not any(s[0] == k and s[1] <= t <= s[2] for s in within):
                    continue
                e = min(x[0][2], y[0][2])
                if last and last[3:] == (x[0][3], y[0][3]):
                    last = want[-1] = (*last[:2], max(last[2], e), *last[3:])
                else:
                    last = (k, t, e, x[0][3], y[0][3])
                    want.append(last)
        s = None if within is None else spark.createDataFrame(within, "k int, start_t double, end_t double")
        assert sorted(map(tuple, J.pair_series(a, b, ["k"], "v", s).collect())) == sorted(want)


def test_the_query_sorts_three_times(spark):
    plan = Q.pair_series(spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 3 and "Aggregate" not in plan
