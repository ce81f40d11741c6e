"""The near-duplicate stage keeps a copy of every text, and one of equal rows."""

import random

import corpus_pipeline
from timeline_engine.llm import parity_join


def prose(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(120))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, n int")
    out = corpus_pipeline.near_stage(spark, docs, "")
    assert out.columns == docs.columns
    return sorted((r.doc_id, r.text) for r in out.collect())


def test_one_id_with_two_texts(spark):
    a, b, c = prose(1), prose(2), prose(3)
    # 7 has a copy of 3's text and a text of its own, which 9 repeats.
    rows = [(3, a), (7, a), (7, b), (9, b), (5, c)]
    assert kept(spark, rows) == sorted([(3, a), (7, b), (5, c)])


def test_two_alike_texts_of_one_id(spark):
    a, b = prose(1), prose(2)
    near = a + " more"
    got = kept(spark, [(4, a), (4, near), (4, b), (8, near), (8, b)])
    assert len(got) == 2 and {i for i, _ in got} == {4} and (4, b) in got


def test_equal_rows_stay_once(spark):
    a, b = prose(1), prose(2)
    assert kept(spark, [(1, a), (1, a), (2, b), (2, b), (2, b), (3, a)]) == [(1, a), (2, b)]
    assert kept(spark, [(1, None), (1, ""), (2, "short"), (2, "short")]) in ([(1, None), (2, "short")], [(1, ""), (2, "short")])


def test_rows_without_an_id_stay(spark):
    docs = spark.createDataFrame([(None, prose(1)), (None, prose(1)), (1, prose(1))], "doc_id bigint, text string")
    assert corpus_pipeline.near_stage(spark, docs, "").count() == 3


def test_unique_ids_give_the_groups_of_the_join(spark):
    rows = [(k, prose(k % 4)) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {r.doc_id for r in parity_join.jaccard_components(docs).collect() if r.doc_id == r.component_id}
    assert {i for i, _ in kept(spark, rows)} == want == set(range(4))
