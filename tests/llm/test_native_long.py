"""The native operators on very long rows and clashing column names."""

import time

from pyspark.sql import functions as F

from timeline_engine.llm import line_dedup, mixing, url_filter


def took(run):
    began = time.time()
    return run(), time.time() - began


def test_a_document_of_a_million_lines(spark):
    many = "\n".join(f"line number {k % 400_000}" for k in range(1_000_000))
    docs = spark.createDataFrame([(1, "line number 7\nline number 399999\nown line of one"), (2, many), (3, "own line of one\nlast line here")], "doc_id long, text string")
    rows, seconds = took(lambda: {r.doc_id: r for r in line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept")).collect()})
    kept = "\n".join(x for x in many.split("\n") if x not in ("line number 7", "line number 399999"))
    import hashlib

    assert (rows[2].n_lines, rows[2].n_dropped) == (1_000_000, 5) and rows[2].kept == hashlib.sha256(kept.encode()).hexdigest()
    assert rows[3].n_dropped == 1 and rows[1].n_dropped == 0
    assert seconds < 60


def test_words_of_a_bitmap_far_apart(spark):
    shared = "a shared line of text"
    for places in ([0], [63], [64], [0, 500], [130, 131, 700], list(range(0, 900, 65))):
        lines = [shared if k in places else f"own line {k} of it" for k in range(900)]
        docs = spark.createDataFrame([(1, shared), (2, "\n".join(lines))], "doc_id long, text string")
        row = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).where("doc_id = 2").first()
        assert row.kept.split("\n") == [x for x in lines if x != shared] and row.n_dropped == len(places)


def test_a_line_of_all_documents_takes_many_salts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LEAST", 10)
    docs = spark.createDataFrame([(i, f"a line that everyone has\nline {i} alone here") for i in range(2_000)], "doc_id long, text string")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert sorted((r.doc_id, r.n_dropped) for r in out.collect()) == [(i, int(i > 0)) for i in range(2_000)]


ODD = ["_h", "_id", "_copies", "a.b", "b`c", "d", "b", "words", "text_hash"]


def odd(spark, rows, names):
    df = spark.createDataFrame([(*r, *range(len(ODD))) for r in rows], ", ".join([*(f"{n} {t}" for n, t in names), *(f"`{c.replace('`', '``')}` int" for c in ODD)]))
    return df, [f"`{c.replace('`', '``')}`" for c in ODD]


def test_clashing_names(spark):
    docs, cols = odd(spark, [(1, "a shared line of text"), (2, "a shared line of text\nmore")], (("doc_id", "long"), ("text", "string")))
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert [tuple(r) for r in out.select(*cols).collect()] == [tuple(range(len(ODD)))] * 2
    assert {r.doc_id: r.kept for r in out.collect()} == {1: "a shared line of text", 2: "more"}
    pages, cols = odd(spark, [(1, "http://x.com/en/1"), (2, None)], (("page_id", "long"), ("url", "string")))
    out = url_filter.judge(pages, url_filter.rules_table(spark))
    assert [tuple(r) for r in out.select(*cols).collect()] == [tuple(range(len(ODD)))] * 2
    assert {r.page_id: r.rule for r in out.collect()} == {1: "com/en/", 2: None}


def test_a_url_of_a_megabyte(spark):
    urls = ["http://" + "a." * 30_000 + "com/en/x", "http://" + "a." * 500_000 + "com/en/x", "http://b.com/en/" + "y" * 1_000_000]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    rows, seconds = took(lambda: url_filter.judge(pages, url_filter.rules_table(spark)).select("page_id", "rule").collect())
    assert sorted(map(tuple, rows)) == [(k, "com/en/") for k in range(3)] and seconds < 30


def test_many_pages_without_a_url(spark):
    pages = spark.createDataFrame([(k, None if k % 3 else f"http://x.com/en/{k % 2}") for k in range(300)], "page_id long, url string")
    out = url_filter.judge(pages, url_filter.rules_table(spark))
    assert sorted((r.page_id, r.rule) for r in out.collect()) == [(k, None if k % 3 else "com/en/") for k in range(300)]


def test_empty_texts_are_taken_at_most_three_times(spark):
    rows = [(i, "" if i < 5 else "w", "a") for i in range(8)] + [(100 + i, "w " * 50, "b") for i in range(40)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert max(r.copies for r in out) == mixing.MAX_EPOCHS


def test_only_empty_texts_beside_a_word(spark):
    rows = [(i, "", "a") for i in range(40)] + [(90, "w", "a")] + [(100 + i, "w " * 50, "b") for i in range(40)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.copies for r in out if r.source == "a"} == {mixing.MAX_EPOCHS}
