"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib

import pytest

from timeline_engine.llm import importance
from timeline_engine.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, most):
    w = WORD.findall(re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in range(1, most + 1) for k in range(len(w) - n + 1)]


def brute(docs, target, most, percent=10, least=20):
    counts = [[1] * 10_000 for _ in range(2)]
    for which, texts in enumerate(([t for _, t in docs], target)):
        for t in texts:
            for b in grams(t, most)[1]:
                counts[which][b] += 1
    s_all, t_all = sum(counts[0]), sum(counts[1])
    gain = [math.floor(1000 * math.log(float(t) * s_all / (float(s) * t_all))) for s, t in zip(*counts, strict=True)]
    rows = []
    for i, text in docs:
        w, b = grams(text, most)
        weight, score = sum(gain[x] for x in b), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(w), len(b), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(((r[0], *r[2:]) for r in rows), key=str)


def tables(spark, docs, target, path):
    schema = "doc_id bigint, text string, score string, part int, words string, `row` int"
    spark.createDataFrame([(i, t, "s", 1, "w", 2) for i, t in docs], schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")


@pytest.mark.parametrize("few", [4096, 7])
def test_equals_plain_version(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(importance, "FEW_ROWS", few)
    docs = [(i, " ".join(f"w{(i * k) % (11 + i % 7)}" for k in range(i % 60))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, " .,; "), (303, "Été ÉTÉ x1 " * 30), (304, "long " * 50_000), (None, "no id " * 30), (7, "same id " * 20)]
    target = ["w1 w2 w3 w4", None, "", "Long x1 été"]
    tables(spark, docs, target, tmp_path)
    got = QUERIES["op13_importance"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, target, 1)


def test_longer_runs_of_words(spark):
    docs = [(i, t) for i, t in enumerate(["a b c a b", "a", "", None, "x y. z"])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    target = spark.createDataFrame([("a b c",)], "text string")
    rows = importance.draw(importance.scored(df, target, most_words=3), 10, 20).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted((tuple(r) for r in rows.collect()), key=str) == brute(docs, ["a b c"], 3)


def test_empty_tables_and_equal_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    text = spark.createDataFrame([("a",)], "text string")
    assert importance.draw(importance.scored(none, text), 10, 20).count() == 0
    same = spark.createDataFrame([(5, "word " * 25)] * 400 + [(6, "word " * 25)] * 20, "doc_id bigint, text string")
    ranks = sorted(r.rank for r in importance.draw(importance.scored(same, none.select("text")), 10, 20).collect() if r.rank)
    assert ranks == list(range(1, 43))
