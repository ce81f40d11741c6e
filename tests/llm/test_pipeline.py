"""The pipeline's stages against plain Python, and the oracles of the queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from timeline_engine.llm import line_dedup, mixing, parity_join, quality_rules, queries

DIR = "/root/testdata/sf0.001"


def values(rows, columns):
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(fix(r[c]) for c in columns) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    named = [dict(zip([d[0] for d in want.description], r, strict=True)) for r in want.fetchall()]
    got = queries.QUERIES[name](spark, DIR)
    assert sorted(got.columns) == columns
    assert values(got.collect(), columns) == values(named, columns)


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("copies", F.lit(1)).withColumn("kept", F.lit("k"))
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    one = stages["quality rules"](spark, docs, DIR).cache()
    assert one.columns == docs.columns
    kept = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in one.collect()} == kept and 0 < len(kept) < docs.count()
    two = stages["line dedup"](spark, one, DIR).cache()
    applied = {r.doc_id: r["_k"] for r in line_dedup.apply_bitmaps(one.drop("kept"), line_dedup.keep_bitmaps(one)).withColumnRenamed("kept", "_k").collect()}
    assert {r.doc_id: r.text for r in two.collect()} == applied and all(r.n_chars == len(r.text) for r in two.collect())
    three = stages["n-gram Jaccard join"](spark, two, DIR).cache()
    found = parity_join.jaccard_components(two).collect()
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in found if r.doc_id == r.component_id}
    four = stages["mixing sources to target weights"](spark, three, DIR).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(three).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()} == copies
    five = stages["packing"](spark, four, DIR)
    assert five.select("doc_id").distinct().count() == len(copies)


def test_empty_corpus(spark, tmp_path):
    spark.read.parquet(f"{DIR}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
