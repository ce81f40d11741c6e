"""Stale files, repeated rows, other tokenizers, located passages, switches."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from timeline_engine.llm import hilbert_pack, parity_join, pu_toxicity, warc_dict, winnowing

RNG = random.Random(11)


def prose(n):
    return " ".join("".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(n))


def test_stale_archives_are_not_read(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"<p>{prose(60)}") for k in range(50)], "page_id bigint, url string, html string")
    folder = "file://" + str(tmp_path / "warc")
    archives = warc_dict.write_archives(pages, folder)
    stale = warc_dict.archive([warc_dict.record(999, "u", b"left by a lost attempt", "0" * 64, None)])
    (tmp_path / "warc" / "part-000000-00077.warc.zst").write_bytes(stale)
    assert sorted(r.page_id for r in warc_dict.read_named(archives, folder).collect()) == list(range(50))


def test_archives_are_the_same_bytes_again(spark, tmp_path):
    rows = [(k % 7, f"u{k % 3}", f"<p>{'x' * 120}{k % 5}") for k in range(200)]
    digests = []
    for name in ("a", "b"):
        random.Random(name).shuffle(rows)
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
        warc_dict.write_archives(pages, "file://" + str(tmp_path / name)).collect()
        digests.append(sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in (tmp_path / name).glob("part-*")))
    assert digests[0] == digests[1] != []


def test_rows_that_repeat_a_page_and_payload(spark, tmp_path):
    big, other = "<p>" + prose(60), "<p>" + prose(50)
    rows = [(1, "b", big), (1, "a", big), (1, "a", big), (2, "c", big), (3, "d", other), (3, "d", other), (None, "e", other), (4, "f", "short"), (4, "f", "short")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc_dict.op7_warc(spark, str(tmp_path)).collect()), key=str)
    want = [(1, "response", None), (1, "revisit", 1), (1, "revisit", 1), (2, "revisit", 1), (3, "response", None), (3, "revisit", 3), (None, "revisit", 3), (4, "response", None), (4, "response", None)]
    assert got == sorted(want, key=str)


def test_a_shared_passage_is_located(spark, tmp_path):
    shared = prose(40)[: winnowing.WINDOW + winnowing.K - 1]
    for _ in range(40):
        before, after = prose(RNG.randint(1, 40)), prose(RNG.randint(1, 40))
        a, b = "é " + before + shared + "x" + after, after + shared + "y" + before
        i, j = a.index(shared), b.index(shared)
        met = winnowing.located(*(winnowing.from_string(winnowing.as_string(*winnowing.winnow(t))) for t in (a, b)))
        inside = [(p, q) for p, q in met if i <= p <= i + winnowing.WINDOW and p - i == q - j]
        assert inside and all(a[p : p + winnowing.K] == b[q : q + winnowing.K] for p, q in met)




@pytest.mark.parametrize("per_bucket", [2, 7])
def test_winnowing_of_one_hot_id(spark, monkeypatch, tmp_path, per_bucket):
    monkeypatch.setattr(winnowing, "DOCS_PER_BUCKET", per_bucket)
    rows = [(5, prose(6)) for _ in range(60)] + [(None, prose(5)) for _ in range(40)] + [(k, prose(4)) for k in range(10, 30)] + [(1, "same text"), (1, "same text")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    parts = winnowing.neighbours(df).collect()
    assert len({r.bucket for r in parts if r.doc_id == 5 and not r.part}) > 3 and len({r.bucket for r in parts if r.doc_id is None and not r.part}) > 3
    from pyspark.sql import functions as F

    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        want.append((i, hashlib.sha256(winnowing.edited(t, after).encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in winnowing.op5_winnowing(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_another_tokenizer_is_read_whole(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert hilbert_pack.by_words(public_tokenizers.path("word_bpe_49k.json")) and not hilbert_pack.by_words(path)
    texts = [prose(40), "Two  spaces, Capitals\nand lines", "", None]
    tokenizer = Tokenizer.from_file(path)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    rows = hilbert_pack.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), path).collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids))


def test_copies_of_one_row_are_spread(spark):
    import public_tokenizers

    rows = hilbert_pack.tokenised(spark.createDataFrame([(7, "one text")] * 50 + [(None, "one text")] * 50, "doc_id bigint, text string"), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert len({r.salt for r in rows}) > 20


def test_both_ways_to_the_texts_of_nodes(spark, monkeypatch):
    from tests.llm.test_free import copies, frame, jaccard_brute

    texts = copies()
    monkeypatch.setattr(parity_join, "MARKS", 64)  # so many nodes that a semi-join finds the texts
    got = sorted(tuple(r) for r in parity_join.jaccard_components(frame(spark, texts)).collect())
    assert got == jaccard_brute(texts)


def test_a_short_list_of_frequent_keys(spark, monkeypatch):
    from tests.llm.test_free import copies, frame, jaccard_brute

    texts = copies()
    monkeypatch.setattr(parity_join, "FREQUENT", 1)
    monkeypatch.setattr(parity_join, "MOST_FREQUENT", 3)
    got = sorted(tuple(r) for r in parity_join.jaccard_components(frame(spark, texts)).collect())
    assert got == jaccard_brute(texts)


def test_training_rows_do_not_depend_on_order(spark, monkeypatch):
    monkeypatch.setattr(pu_toxicity, "MOST_UNLABELLED", 40)
    rows = [(k, ("you vile thing " if k % 9 == 0 else "") + prose(12)) for k in range(300)] + [(500, "one row again")] * 200
    labels = spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(300)], "doc_id bigint, toxic int")
    models = []
    for n in (1, 5):
        random.Random(n).shuffle(rows)
        models.append(pu_toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(n), labels))
    assert models[0] == models[1] and models[0][0]
