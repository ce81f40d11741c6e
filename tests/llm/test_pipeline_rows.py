"""The pipeline's stages on repeated rows, ids and clashing column names."""

import corpus_pipeline
from timeline_engine.llm import mixing

ODD = ["_h", "_id", "_copies", "_n", "_rows", "_number", "_kept", "copies", "a.b", "c0", "c1"]
STAGES = dict(corpus_pipeline.STAGES)


def docs(spark, rows):
    odd = ", ".join(f"`{c}` int" for c in ODD)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *range(len(ODD))) for i, t, s in rows], f"doc_id bigint, text string, lang string, source string, n_chars bigint, {odd}")


def text(k, n=40):
    return " ".join(f"the word{(k * 31 + j * 17) % 97}{j % 7} of" for j in range(n // 2))


def test_mix_emits_the_planned_words_of_repeated_rows(spark):
    rows = [(1, text(1), "a")] * 7 + [(1, text(2), "a")] * 2 + [(1, text(1), "b")] * 3 + [(None, text(3), "b")] * 5 + [(k, text(k), "abc"[k % 3]) for k in range(10, 40)]
    df = docs(spark, rows)
    plan = mixing.mix(df).collect()
    out = STAGES["mixing sources to target weights"](spark, df, "").collect()
    for source in "abc":
        assert sum(len(r.text.split()) for r in out if r.source == source) == sum(r.taken for r in plan if r.source == source)
    assert len(out) == sum(r.copies for r in plan)


def test_clashing_names_pass_all_stages(spark):
    df = docs(spark, [(k, text(k) + f"\na line of {k} alone", "ab"[k % 2]) for k in range(12)] + [(None, text(50), "a"), (3, text(60), "b")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns, name
        rows = out.collect()
        assert rows and all(tuple(r[5:]) == tuple(range(len(ODD))) for r in rows), name
    assert corpus_pipeline.pack_stage(spark, df, "").count() >= 14


def test_rows_without_an_id_are_numbered_by_parts(spark):
    """Equal rows lie in many partitions; each part is numbered alone and the numbers still run from 1 to their count."""
    from pyspark.sql import functions as F

    rows = spark.range(4_000, numPartitions=8).select(F.lit(None).cast("bigint").alias("_id"), F.lit(5).cast("bigint").alias("_h"), F.when(F.col("id") % 4 == 0, F.lit("a")).alias("_s"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    got = corpus_pipeline._numbered(rows)
    assert got.select("_part").distinct().count() == 8
    for s, n in (("a", 1_000), (None, 3_000)):
        assert sorted(r._n for r in got.where(F.col("_s").eqNullSafe(F.lit(s))).collect()) == list(range(1, n + 1))
