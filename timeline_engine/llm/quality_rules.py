"""Document quality by weak supervision.

Rules look at a document and vote good (1), bad (2) or abstain (0). Votes
depend on an unknown class; expectation-maximisation over the counts of vote
patterns estimates each rule's vote probabilities given the class, and the
class prior. The posterior of "good" given a document's votes then decides,
instead of a demand that all rules pass. A document that fails the two base
rules is never kept.

A rule that knows some languages only must not speak on the others: the rule of
function words votes good or abstains, so prose in a language without a list
loses a vote and is judged by the rules on form.

Only pattern counts reach the driver: at most 3 to the number of rules (3^10 =
59,049), whatever the corpus; they are counted over all documents. Posteriors
return as one small table of the same bound, which is broadcast.

Nulls: a null text has no words and fails the base rules. Rows that repeat a
doc_id are judged each by its own text. An empty table gives an empty table
(the prior alone remains). Other columns are ignored.
"""

from __future__ import annotations

import operator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, ngram_hashes, table, word_hashes, written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
REPEAT_WORDS = 8
#: Rows of texts in one Arrow batch.
TEXT_ROWS = 2_000
#: Function words of the corpus languages; only their share counts.
FUNCTION_WORDS = (
    "the of and to in a is that for it with as was on be by this are from at "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine "
    "le la les de des et en un une du est que dans qui pour sur par au "
    "el los las y del se por con una su para es al lo"
).split()
GOOD, BAD, ABSTAIN = 1, 2, 0
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = "doc_id bigint, text_hash bigint, " + ", ".join(f"{c} bigint" for c in _FEATURES) + ", pattern int"

#: (name, direction, good bound, bad bound): with direction 1 values up to the
#: good bound are good and from the bad bound on are bad; with -1 the reverse.
#: Between the bounds a rule abstains, and beyond the good one if it has no bad
#: bound. Ratios whose base is empty abstain.
RULES = (
    ("symbols per word", 1, 0.1, 0.3),
    ("share of repeated words", 1, 0.1, 0.3),
    ("share of repeated lines", 1, 0.3, 0.6),
    ("share of upper-case letters", 1, 0.15, 0.4),
    ("mean word length", 1, 10.0, 14.0),
    ("share of words with a letter", -1, 0.9, 0.75),
    ("share of function words", -1, 0.12, None),
    ("exclamation marks per word", 1, 0.1, 0.3),
    ("share of words without a symbol", -1, 0.95, 0.7),
    ("share of words equal to the word before", 1, 0.05, 0.2),
)


#: Turns every symbol into the first one.
_ONE_SYMBOL = bytes.maketrans(SYMBOLS.encode(), SYMBOLS[:1].encode() * len(SYMBOLS))


@lru_cache(1)
def _class_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is an upper-case letter, and a letter."""
    upper, letter = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    for c, x in enumerate(map(chr, range(0x110000))):
        if x.isalpha():
            letter[c], upper[c] = True, x.isupper()
    return upper, letter


def repeated_words(hashes: np.ndarray, n: int = REPEAT_WORDS) -> int:
    """Words covered by n-word windows that occur at least twice."""
    grams = ngram_hashes(hashes, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure(text: str, tables, function_words: frozenset) -> tuple[tuple[int, ...], list[float | None]]:
    """The base counts of a text and the values the rules look at."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    real = [x for x in lines if x.strip(SPACES)] if len(lines) > 1 else lines
    dup_lines = len(real) - len(set(real))
    repeats = repeated_words(word_hashes(raw)) if n >= REPEAT_WORDS + 1 else 0
    if not n:
        return (0, word_chars, symbols, 0, 0), [None] * len(RULES)
    upper, letter = tables
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[codes]
    letters = int(np.count_nonzero(is_letter))
    # Words with a letter: letters that no letter of the same word precedes.
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    word_no = np.cumsum(space)[is_letter]
    lettered = int(np.count_nonzero(np.diff(word_no))) + 1 if len(word_no) else 0
    functional = sum(map(function_words.__contains__, words))
    mark = SYMBOLS[:1].encode()
    symbolic = sum(mark in w for w in raw.translate(_ONE_SYMBOL).split()) if symbols else 0
    values = [
        symbols / n,
        repeats / n,
        dup_lines / len(real) if len(real) > 2 else None,
        int(np.count_nonzero(upper[codes])) / letters if letters else None,
        word_chars / n,
        lettered / n,
        functional / n,
        text.count("!") / n,
        1 - symbolic / n,
        sum(map(operator.eq, words, words[1:])) / n,
    ]
    return (n, word_chars, symbols, dup_lines, repeats), values


def vote(values: list[float | None]) -> int:
    """The votes on a document as one base-3 number, first rule lowest."""
    pattern = 0
    for k, ((_, direction, good, bad), x) in enumerate(zip(RULES, values, strict=True)):
        if x is not None:
            v = GOOD if direction * x <= direction * good else BAD if bad is not None and direction * x >= direction * bad else ABSTAIN
            pattern += v * 3**k
    return pattern


def _measure_batches(batches):
    tables = _class_tables()
    listed = frozenset(w.encode() for w in FUNCTION_WORDS) | frozenset(w.capitalize().encode() for w in FUNCTION_WORDS)
    for batch in batches:
        rows = []
        for text in batch.column(2):
            base, values = measure(text.as_py() or "", tables, listed)
            rows.append((*base, vote(values)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        arrays = [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", *_FEATURES, "pattern"])


def fit(patterns: list[int], counts: list[int], rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """(prior of good, vote probabilities [rule, class, vote], posterior of good
    per pattern) by expectation-maximisation with weak priors: a bad vote is
    rare on good documents, and good documents are the majority. A rule
    abstains as often on either class."""
    k = len(RULES)
    votes = (np.array(patterns, np.int64)[:, None] // 3 ** np.arange(k)) % 3
    n = np.array(counts, float)
    #: pseudo-counts [class good/bad, vote abstain/good/bad]
    pseudo = np.array([[2.0, 20.0, 0.1], [1.0, 7.0, 2.5]])

    def rates(seen: np.ndarray) -> np.ndarray:
        silent = seen[:, 0].sum() / seen.sum()  # abstaining tells nothing
        said = seen[:, 1:] / seen[:, 1:].sum(1, keepdims=True)
        return np.column_stack([[silent, silent], (1 - silent) * said])

    p = np.repeat(rates(pseudo)[None], k, 0)
    prior, post = 0.85, np.zeros(len(n))
    for _ in range(rounds):
        log = np.zeros((len(n), 2))
        for j in range(k):
            log += np.log(p[j][:, votes[:, j]]).T
        odds = log[:, 0] - log[:, 1] + np.log(prior / (1 - prior))
        now = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done = len(n) == 0 or np.max(np.abs(now - post)) < 1e-9
        post = now
        weight = np.stack([n * post, n * (1 - post)])
        prior = (weight[0].sum() + 17) / (n.sum() + 20)
        for j in range(k):
            p[j] = rates(np.stack([[w[votes[:, j] == v].sum() for v in range(3)] for w in weight]) + pseudo)
        if done:
            break
    return prior, p, post


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, the five counts, base_failed, p_good, kept), one row
    a document."""
    spark = docs.sparkSession
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    measured = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash.alias("text_hash"), "text").mapInArrow(_measure_batches, _SCHEMA)
    with arrow_rows(spark, TEXT_ROWS):
        measured = written(measured, "quality-votes")
    counted = sorted((r[0], r[1]) for r in measured.groupBy("pattern").count().collect())
    patterns, counts = [x[0] for x in counted], [x[1] for x in counted]
    _, _, post = fit(patterns, counts)
    posterior = spark.createDataFrame([(p, float(x)) for p, x in zip(patterns, post, strict=True)], "pattern int, p_good double")
    out = measured.join(F.broadcast(posterior), "pattern")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("p_good") >= 0.5))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Per document: base counts, base failure, and whether it is kept."""
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *_FEATURES, "base_failed", "kept", "p_good")
