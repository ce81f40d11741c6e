"""Toxicity: bounds hold for rows; counts cover the corpus; scores follow from weights."""

import math
import random
import re
from collections import Counter

import xxhash

from timeline_engine.llm import pu_toxicity as T


def prose(rng, n=12):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def tables(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_one_toxic_id_of_many_texts(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_POSITIVE", 50)
    rng = random.Random(1)
    rows = [(1, f"vile {prose(rng)}") for _ in range(10_000)] + [(k, prose(rng)) for k in range(2, 400)]
    docs, labels = tables(spark, rows, [(1, 1)] + [(k, 0) for k in range(2, 400)])
    seen, plain = [], T.train
    monkeypatch.setattr(T, "train", lambda vocabulary, positive, *rest: seen.append(len(positive)) or plain(vocabulary, positive, *rest))
    weights, _, _ = T.fit(docs, labels)
    assert seen == [50] and xxhash.xxh32_intdigest("vile") in weights


def test_features_are_counted_over_all_texts(spark, monkeypatch):
    """A word that the small sample of unlabelled texts hardly shows, but most of the corpus holds, is no feature."""
    monkeypatch.setattr(T, "MOST_UNLABELLED", 10)
    rng = random.Random(2)
    rows = [(k, f"vile common {prose(rng)}") for k in range(40)] + [(k, f"{'common ' if k % 3 else ''}{prose(rng)}") for k in range(40, 900)]
    docs, labels = tables(spark, rows, [(k, int(k < 40)) for k in range(900)])
    weights, _, _ = T.fit(docs, labels)
    assert xxhash.xxh32_intdigest("vile") in weights and xxhash.xxh32_intdigest("common") not in weights


def plain_score(text, weights, size_weight, intercept):
    words = Counter((text or "").lower().split())
    found = Counter()
    for w, n in words.items():
        bare = re.sub(rf"^[{re.escape(T.MARKS)}]+|[{re.escape(T.MARKS)}]+$", "", w)
        for part in [bare, *(bare[:k] + "-" for k in T.STEMS if len(bare) > k)] if bare else []:
            found[xxhash.xxh32_intdigest(part)] += n
    hit = set(found) | {h ^ T.TWICE for h, n in found.items() if n > 1}
    g = intercept + size_weight * math.log1p(len(words)) / 4 + sum(weights.get(h, 0.0) for h in hit)
    return 1 / (1 + math.exp(-g))


def test_scores_equal_a_plain_sum_of_weights(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = T.fit(docs, labels)
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "!!! ,,")], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in T.score(both, *model).collect():
        assert math.isclose(r.score, plain_score(texts[r.doc_id], *model), rel_tol=1e-9)
        assert r.predicted == int(r.score >= 0.5)
