"""Queries do the whole job: no row is left out by a cut of ids or blocks."""

import os
import random

import duckdb
import pytest

from timeline_engine import catalog
from timeline_engine.operators import sequences as S
from timeline_engine.operators import temporal_joins as J
from timeline_engine.plans.inputs import RUNS

DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def whole(name, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(DIR, name)}.parquet'")
    return sorted(con.execute(sql).fetchall())


OVERLAPS = f"""WITH {RUNS} SELECT user_id, start_t, end_t FROM r a WHERE event_type = 'view' AND EXISTS (
  SELECT 1 FROM r b WHERE b.event_type = 'click' AND b.user_id <> a.user_id AND a.start_t <= b.end_t AND b.start_t <= a.end_t)"""


def test_overlaps_of_all_users_and_days(spark):
    want = whole("events", OVERLAPS)
    assert rows(catalog.QUERIES["interval_overlap_semi"](spark, DIR)) == want
    assert {r[0] % 2 for r in want} == {0, 1}


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_others(spark, seed):
    rng = random.Random(seed)

    def spans(n):
        starts = [(rng.choice([1, 2, 3, 4, None] if k % 9 == 0 else [1, 2]), float(rng.randint(0, 400))) for k in range(n)]
        return [(u, t, t + rng.choice([0, 0, 1, 5, 60])) for u, t in starts]

    a, b = spans(150), spans(25)
    want = sorted(x for x in a if any(x[0] is not None and y[0] is not None and x[0] != y[0] and x[1] <= y[2] and y[1] <= x[2] for y in b))
    x, y = (spark.createDataFrame(s, "who int, start_t double, end_t double") for s in (a, b))
    assert 0 < len(want) < len(a)
    assert rows(J.overlapping_others(x, y, "who", 10.0)) == want


SUCCESSORS = """WITH s AS (SELECT vec_id, label, lead(label) OVER (ORDER BY vec_id) AS next FROM embeddings),
c AS (SELECT label, next, count(*)::BIGINT AS weight, min(vec_id) AS seen FROM s WHERE next IS NOT NULL GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, seen) AS rn FROM c) SELECT label, next, weight FROM k WHERE rn = 1"""


def test_successors_across_blocks(spark):
    assert rows(catalog.QUERIES["modal_successor"](spark, DIR)) == whole("embeddings", SUCCESSORS)


def test_successors_of_ids_far_apart(spark, tmp_path):
    found = [(k * 150, k % 3) for k in range(30)]
    spark.createDataFrame(found, "vec_id bigint, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert rows(catalog.QUERIES["modal_successor"](spark, str(tmp_path))) == [(0, 1, 10), (1, 2, 10), (2, 0, 9)]


@pytest.mark.parametrize("per_block", [1, 3, 1000])
def test_with_next_passes_empty_blocks(spark, per_block):
    ids = sorted({*range(20), 500, 501, 10**6, -(10**9), 2**40})
    df = spark.createDataFrame([(i, str(i)) for i in ids], "i bigint, s string")
    want = sorted((i, str(i), str(j)) for i, j in zip(ids, ids[1:]))
    got = S.with_next(df, "i", ["s"], per_block).collect()
    assert sorted(tuple(r) for r in got if r[2] is not None) == want and len(got) == len(ids)
    assert S.with_next(df.limit(0), "i", ["s"]).count() == 0


@pytest.mark.parametrize("times, want", [([0.0, 500.0, 1300.0, 1700.0], (400.0, "sparse")), ([0.0, 150.0, 159.9, 10_000.0], (9.9, "sparse")), ([0.0, 61.0, 250.0], (61.0, "sparse")), ([5.0], (None, "sparse")), ([0.0, 0.25, 900.0], (0.25, "dense"))])
def test_steps_of_any_length(spark, times, want):
    found = S.infer_preset(spark.createDataFrame([(t,) for t in times], "t double"), "t").first()
    assert (found.min_step is None and want[0] is None or found.min_step == pytest.approx(want[0])) and found.preset == want[1]


def test_more_templates_than_constants(spark):
    from timeline_engine.plans import bitmap_queries as B

    bitmaps, templates = B._bitmaps(spark, DIR), B._templates(spark, DIR)
    assert rows(B.nearest_two(bitmaps, templates, 3)) == rows(B.nearest_two(bitmaps, templates, 1000))
