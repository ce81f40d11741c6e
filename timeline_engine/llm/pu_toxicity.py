"""Toxicity scores by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts and unlabelled texts only. With class
prior pi, losses l and the linear score g, the risk

    pi * E_p[l(g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)])

is minimised (the clamp keeps the estimated negative risk from going below
zero; while it is negative, the step goes uphill on that part alone, as the
non-negative estimator prescribes). Features are the hashed distinct words of a
text, and their beginnings, whose share among the toxic texts exceeds that
among the unlabelled ones by more than chance; weights are not negative.

Training reads at most ``MOST_POSITIVE`` confirmed toxic texts, those of least
hash of (doc_id, text), so that one doc_id with any number of texts can't pass
the bound. Unlabelled evidence covers every document: the features of the toxic
texts are counted over all texts of the corpus (a combined count of bounded
size), and these counts choose the features. Only the optimiser, whose steps
need single texts, sees a sample of at most ``MOST_UNLABELLED`` of them, those
of least hash of (doc_id, text). No sample depends on the order of rows. Of the
texts trained on, only their size and the numbers of the chosen features they
hold reach the driver. The class prior is the share of toxic rows among all
labelled training rows. Scores cover every document.

Nulls: a null or empty text has no features and scores by the intercept. Null
labels and labels of unknown documents are ignored; a doc_id labelled twice is
toxic if either label says so. Without a toxic training row every score is 0. A
null doc_id is not held out. Repeated rows are scored alike. An empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

MOST_POSITIVE = 4000
MOST_UNLABELLED = 12_000
#: Features counted over the corpus: those that most toxic texts hold.
MOST_COUNTED = 300_000
#: Standard deviations beyond which a feature of the sample is not counted over the corpus.
SURE = 6.0
FOLDS = 5
#: Hashes of rows are placed evenly among so many.
PLACES = 1 << 40
#: A word must exceed its expected number of toxic texts by so many standard
#: deviations to become a feature.
LEAST_Z = 4.0
#: Least estimated share of toxic texts among those with a feature.
LEAST_SHARE = 0.6
#: Lengths of the beginnings of words that are features too.
STEMS = (4, 5, 6, 7)
#: Flips the hash of a feature that occurs at least twice.
TWICE = 0x5BD1E995
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def word_features(word: str) -> list[int]:
    """32-bit hashes of a word and of its beginnings, which stand for stems."""
    parts = [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]
    return [xxhash.xxh32_intdigest(x) for x in parts]


def words_of(text: str | None) -> Counter:
    """How often each lower-cased word occurs, with the marks around it."""
    return Counter((text or "").lower().split())


def size_of(n_words: int) -> float:
    """The dense feature: in a long text a weak hint is likely by chance."""
    return math.log1p(n_words) / 4


def features(text: str | None, known: dict[str, tuple[int, ...]] | None = None) -> np.ndarray:
    """The number of distinct words, then the sorted distinct feature hashes:
    of what occurs, and anew of what occurs twice. ``known`` keeps the features
    of words from call to call."""
    known = {} if known is None else known
    words, seen = words_of(text), {}
    for word, n in words.items():
        found = known.get(word)
        if found is None:
            bare = word.strip(MARKS)
            found = known[word] = tuple(word_features(bare)) if bare else ()
        for h in found:
            seen[h] = seen.get(h, 0) + n
    if len(known) > 200_000:
        known.clear()
    return np.array([len(words), *sorted(set(seen) | {h ^ TWICE for h, n in seen.items() if n > 1})], np.uint32)


def hits(words: Counter, known: dict[str, tuple[int, ...]], wanted) -> list[int]:
    """Those of a text's features that ``wanted`` holds, sorted. ``known`` keeps
    from call to call, per word, its features that may matter."""
    seen: dict[int, int] = {}
    for word, n in words.items():
        found = known.get(word)
        if found is None:
            bare = word.strip(MARKS)
            found = known[word] = tuple(h for h in word_features(bare) if h in wanted or h ^ TWICE in wanted) if bare else ()
        for h in found:
            seen[h] = seen.get(h, 0) + n
    if len(known) > 300_000:
        known.clear()
    return sorted(h for h in set(seen) | {h ^ TWICE for h, n in seen.items() if n > 1} if h in wanted)


def _corpus_batches(counted: np.ndarray):
    """(feature, texts that hold it) of the ``counted`` features, per task."""
    place = {int(h): k for k, h in enumerate(counted)}

    def run(batches):
        known: dict[str, tuple[int, ...]] = {}
        n = np.zeros(len(counted), np.int64)
        for batch in batches:
            for text in batch.column(0):
                n[[place[h] for h in hits(words_of(text.as_py()), known, place)]] += 1
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(counted[some].astype(np.int64)), pa.array(n[some])], names=["feature", "n_u"])

    return run


def _feature_batches(batches):
    known: dict[str, tuple[int, ...]] = {}
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t.as_py(), known).tobytes() for t in batch.column(1)], pa.binary())], names=["toxic", "f"])


def _count_batches(batches):
    """(feature, texts of either kind that hold it), combined per batch."""
    for batch in batches:
        kind = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        sets = [np.frombuffer(f.as_py(), np.uint32)[1:] for f in batch.column(1)]
        found, at = np.unique(np.concatenate([*sets, np.empty(0, np.uint32)]), return_inverse=True)
        toxic = np.repeat(kind, [len(s) for s in sets])
        n = [np.bincount(at[m], minlength=len(found)).astype(np.int64) for m in (toxic, ~toxic)]
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n[0]), pa.array(n[1])], names=["feature", "n_p", "n_u"])


def _hit_batches(vocabulary: np.ndarray):
    """Of each text its size and the numbers of the chosen features it holds."""

    def run(batches):
        for batch in batches:
            sizes, hits = [], []
            for f in batch.column(1):
                s = np.frombuffer(f.as_py(), np.uint32)
                sizes.append(int(s[0]))
                at = np.minimum(np.searchsorted(vocabulary, s[1:]), len(vocabulary) - 1)
                hits.append(at[vocabulary[at] == s[1:]].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(hits, pa.binary())], names=["toxic", "size", "hits"])

    return run


def fold(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def chosen_features(counts: DataFrame, n_pos: int, n_unl: int, prior: float) -> np.ndarray:
    """Sorted features that occur among the toxic texts beyond chance; if none
    does, the twenty likeliest. ``counts``: feature, n_p, n_u."""
    expected = F.lit(float(n_pos)) * (F.col("n_u") + 0.5) / F.lit(float(n_unl + 1))
    z = (F.col("n_p") - expected) / F.sqrt(expected + 1)
    scored = counts.where(F.col("n_p") > 0).withColumn("z", z)
    # Of texts with a feature, n_p / expected * prior are toxic.
    sure = scored.where((F.col("z") > LEAST_Z) & (F.col("n_p") * F.lit(prior) > F.lit(LEAST_SHARE) * expected))
    found = [r[0] for r in sure.select("feature").collect()] or [r[0] for r in scored.orderBy(F.desc("z"), "feature").limit(20).collect()]
    return np.sort(np.array(found, np.uint32))


def train(vocabulary: np.ndarray, positive: list[tuple[int, bytes]], unlabelled: list[tuple[int, bytes]], prior: float, steps: int = 400) -> tuple[dict[int, float], float, float]:
    """(weight by feature hash, weight of the size, intercept) by Adam on the
    non-negative risk with logistic loss and a small ridge. Texts are given as
    (number of words, numbers of their features in the vocabulary)."""
    if not positive or not unlabelled:
        return {}, 0.0, -60.0
    if not len(vocabulary):
        return {}, 0.0, float(np.log(prior / (1 - prior)))

    def rows(texts):
        hits = [np.frombuffer(h, np.uint32) for _, h in texts]
        return np.repeat(np.arange(len(hits)), [len(h) for h in hits]), np.concatenate([*hits, np.empty(0, np.uint32)]).astype(np.int64)

    size_p, size_u = (np.array([size_of(n) for n, _ in texts]) for texts in (positive, unlabelled))
    (rp, cp), (ru, cu) = rows(positive), rows(unlabelled)
    k, n_pos, n_unl = len(vocabulary), len(positive), len(unlabelled)
    w, first, second = np.zeros(k + 2), np.zeros(k + 2), np.zeros(k + 2)
    w[:k] = 0.1
    w[k] = -2.0
    for step in range(1, steps + 1):
        gp = np.bincount(rp, w[cp], n_pos) + w[k] + w[k + 1] * size_p
        gu = np.bincount(ru, w[cu], n_unl) + w[k] + w[k + 1] * size_u
        # Slopes of log(1 + exp(-g)) and log(1 + exp(g)).
        up, down_p, down_u = -_sigmoid(-gp), _sigmoid(gp), _sigmoid(gu)
        negative = np.mean(np.logaddexp(0, gu)) - prior * np.mean(np.logaddexp(0, gp))
        d_p, d_u = -prior * down_p / n_pos, down_u / n_unl
        if negative >= 0:
            d_p = d_p + prior * up / n_pos
        else:
            d_p, d_u = -d_p, -d_u
        grad = np.append(np.bincount(cp, d_p[rp], k) + np.bincount(cu, d_u[ru], k), [d_p.sum() + d_u.sum(), d_p @ size_p + d_u @ size_u])
        grad[:k] += 1e-4 * w[:k]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w = w - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w[:k] = np.maximum(w[:k], 0.0)
    return {int(h): float(x) for h, x in zip(vocabulary, w[:k], strict=True)}, float(w[k + 1]), float(w[k])


def _score_batches(weights: dict[int, float], size_weight: float, intercept: float):
    def run(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            g = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                g.append(intercept + size_weight * size_of(len(words)) + sum(weights[h] for h in hits(words, known, weights)))
            p = _sigmoid(np.array(g, float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def sampled_texts(rows: DataFrame, most: int, about: int) -> DataFrame:
    """(text) of the ``most`` distinct rows (doc_id, text) of least hash, of
    about ``about`` rows. Only hashes are put in order."""
    place = F.pmod(F.xxhash64(F.lit("row"), F.col("doc_id"), F.col("text")), F.lit(PLACES))
    placed = rows.select(place.alias("place"), "text")
    # Places are even: half as many again as are wanted lie below this bound.
    bound = min(PLACES, int(1.5 * PLACES * most / max(1, about)) + 1)
    last = placed.where(F.col("place") < bound).select("place").distinct().orderBy("place").limit(most).agg(F.max("place")).first()[0]
    return placed.where(F.col("place") <= (-1 if last is None else last)).groupBy("place").agg(F.first("text").alias("text")).select("text")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, float], float, float]:
    """Weights, weight of the size, and intercept from the labels' training folds and the texts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("int"))).first()
    if not toxic:
        return {}, 0.0, -60.0
    prior = min(max(toxic / n, 1e-4), 0.9)
    by_hash = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    confirmed = known.where(F.col("toxic") == 1).orderBy(by_hash, "doc_id").limit(MOST_POSITIVE).select("doc_id")
    pick = docs.select("doc_id", "text")
    # At most MOST_POSITIVE ids: safe to broadcast. Their texts may be more.
    of_toxic = pick.join(F.broadcast(confirmed), "doc_id", "left_semi")
    positive = sampled_texts(of_toxic, MOST_POSITIVE, of_toxic.count()).dropDuplicates()
    n_docs = pick.count()
    unlabelled = sampled_texts(pick, MOST_UNLABELLED, n_docs)
    both = positive.select(F.lit(True).alias("toxic"), "text").unionAll(unlabelled.select(F.lit(False), "text"))
    sampled = written(both.mapInArrow(_feature_batches, "toxic boolean, f binary"), "toxicity-features")
    n_pos, n_unl = sampled.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    if not n_pos or not n_unl:
        return {}, 0.0, -60.0
    of_toxic = sampled.mapInArrow(_count_batches, "feature bigint, n_p bigint, n_u bigint").groupBy("feature").agg(F.sum("n_p").alias("n_p"), F.sum("n_u").alias("n_u"))
    of_toxic = written(of_toxic.where(F.col("n_p") > 0), "toxic-features")
    # The corpus is asked about features that can still be chosen: held by more
    # than LEAST_Z toxic texts, and in the sample not SURE deviations above the
    # largest share of all texts that leaves them toxic. Without any, about those
    # of enough toxic texts, or about all.
    most = F.col("n_p") * F.lit(prior * n_unl / (LEAST_SHARE * n_pos))
    enough = of_toxic.where(F.col("n_p") > LEAST_Z)
    asked = enough.where(F.col("n_u") <= most + SURE * F.sqrt(most + 1))
    often = next((x for x in (asked, enough) if not x.isEmpty()), of_toxic)
    often = often.orderBy(F.desc("n_p"), "feature").limit(MOST_COUNTED)
    counted = np.sort(often.select("feature").toArrow().column(0).to_numpy()).astype(np.uint32)
    whole = pick.select("text").mapInArrow(_corpus_batches(counted), "feature bigint, n_u bigint").groupBy("feature").agg(F.sum("n_u").alias("n_u"))
    counts = of_toxic.select("feature", "n_p").join(whole, "feature")
    vocabulary = chosen_features(counts, n_pos, n_docs, prior)
    if not len(vocabulary):
        return train(vocabulary, [(0, b"")], [(0, b"")], prior)
    # At most MOST_POSITIVE + MOST_UNLABELLED rows of a few numbers.
    hits = sorted((r[0], r[1], bytes(r[2])) for r in sampled.mapInArrow(_hit_batches(vocabulary), "toxic boolean, size bigint, hits binary").collect())
    return train(vocabulary, [h[1:] for h in hits if h[0]], [h[1:] for h in hits if not h[0]], prior)


def score(docs: DataFrame, weights: dict[int, float], size_weight: float, intercept: float) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_score_batches(weights, size_weight, intercept), "doc_id bigint, score double, predicted int")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: whether it is held out, its toxicity, the predicted label."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return score(docs, *model).select("doc_id", held.alias("held_out"), "score", "predicted")
