"""Steps of the broadcasts: boards, clocks, spans, pairs in one scan."""

import random

from pyspark.sql import functions as F

from timeline_engine.operators import temporal_joins as J
from timeline_engine.plans import segment_queries as Q
from timeline_engine.plans import segments as G

DIR = "/root/testdata/sf0.001"


def test_the_board_is_kept_before_a_row_becomes_eight(spark):
    board = Q._board(Q._instants(spark, DIR))
    assert "Generate explode" in board._jdf.queryExecution().optimizedPlan().toString()
    assert board.count() == 8 * spark.read.parquet(f"{DIR}/events.parquet").where(F.col("event_type").isin("signup", "purchase")).count()


def test_clocks_are_written_as_before(spark):
    rows = spark.range(-130, 6_000).select((F.col("id") * 7 % 4_000).alias("x")).union(spark.createDataFrame([(None,)], "x bigint"))
    old = F.format_string("%d:%02d", F.floor(F.col("x") / 60), F.col("x") % 60)
    assert rows.where(F.col("x").isNotNull()).where(~Q._clock(F.col("x")).eqNullSafe(old)).count() == 0
    assert "format_string" not in rows.select(Q._clock(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()


def test_covered_equals_a_semi_join(spark):
    rng = random.Random(9)
    at = lambda: rng.choice((None, *map(float, range(0, 60, 3))))
    points = [(rng.choice((None, 1, 2, 3)), at(), k) for k in range(200)]
    spans = [(rng.choice((None, 1, 2)), a, a if a is None else a + rng.choice((0.0, 1.0, 9.0))) for a in (at() for _ in range(12))] + [(2, 4.0, None)]
    p, s = spark.createDataFrame(points, "vod int, t double, id int"), spark.createDataFrame(spans, "vod int, a double, b double")
    want = sorted(r[2] for r in points if None not in r and any(r[0] == v and None not in (a, b) and a <= r[1] <= b for v, a, b in spans))
    found = J.covered(p, s, ["vod"], "t", "a", "b")
    assert sorted(r.id for r in found.collect()) == want and found.columns == p.columns
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_pair_scans_the_header_once(spark):
    header = G.Header(Q._header(Q._instants(spark, DIR)))
    merged = header.pair_plan("score_left", "score_right")
    assert merged._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    apart = J.pair_series(header.field("score_left"), header.field("score_right"), ["vod"], "value", header.series_spans)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, apart.collect()))
