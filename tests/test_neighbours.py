"""Neighbour counts of packed bitmaps against all pairs and the oracle."""

import random
from collections import Counter

import duckdb

from timeline_engine.operators import clustering as C
from timeline_engine.plans import bitmap_queries as B


def test_counts_in_blocks_equal_all_pairs(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(5)]
    rows = {(k % 3, rng.choice(base) ^ sum(1 << rng.randrange(64) for _ in range(14)) & (2**64 - 1)) for k in range(300)}
    n = {row: rng.choice((1, 1, 1, 4)) for row in rows}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(k, signed(x), c) for (k, x), c in n.items()] + [(None, 1, 1)], "label int, bits bigint, n bigint")
    want = {(k, signed(x)): sum(c for (j, y), c in n.items() if j == k and (x ^ y).bit_count() <= 24) for k, x in n}
    for block in (20, 1_000):
        got = C.near_counts(df, "label", 24, block).collect()
        assert Counter({(r.label, r.bits): r.near for r in got}) == want and len(got) == len(want)


def test_repeated_and_missing_ids_equal_the_oracle(spark, tmp_path):
    rng = random.Random(3)
    vector = lambda: [rng.choice((-1.0, 1.0)) for _ in range(64)]
    one = vector()
    near = [[-x if i < 9 else x for i, x in enumerate(one)], [-x if i < 30 else x for i, x in enumerate(one)]]
    rows = [(k // 2, rng.choice([one, *near, vector()]), k % 2) for k in range(80)] + [(None, one, 0), (None, one, 1), (90, one, None), (91, one, None)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = Counter(con.sql(B.ORACLE_SQL["medoid_neighbours"]).fetchall())
    assert Counter(tuple(r) for r in B.medoid_neighbours(spark, str(tmp_path)).collect()) == want
