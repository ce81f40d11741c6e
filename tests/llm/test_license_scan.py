"""Licence scans against a plain reading, and the expression parser."""

import random
import re

import pytest

from timeline_engine.llm import license_scan as scans
from timeline_engine.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text, phrases):
    found, w = [], words(text)
    for phrase, label in phrases.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(w)) if w[k : k + len(p)] == p]
    return sorted(found)


def tokens(line, open_=True):
    return scans.whole_expression(line, 0, len(line), open_)[0]


def meaning(line, open_=True):
    labels, permissive = scans.evaluate(scans.postfix(tokens(line, open_)))
    return sorted(labels), permissive


def test_spans_equal_a_plain_search():
    rng = random.Random(3)
    vocabulary = "cc by nc sa all rights reserved general public license lesser gnu mit version 3 0 é".split()
    phrases = {**scans.BASE}
    for _ in range(300):
        marks = [rng.choice([" ", "-", "\n", ", ", " . ", "  "]) for _ in range(60)]
        text = "".join(rng.choice([w, w.upper()]) + m for w, m in zip(rng.choices(vocabulary, k=60), marks, strict=True))
        n, spans, _, score = scans.scan(text)
        assert n == len(words(text))
        assert sorted((s[0], s[2]) for s in spans if s[3]) == places(text, phrases)
        own = {p: label for p, (label, _) in scans.NOTICES.items()}
        assert sorted((s[0], s[2]) for s in spans if not s[3]) == places(text, own)
        assert 0 <= score <= 1


@pytest.mark.parametrize(
    ("line", "labels", "permissive"),
    [
        (" mit", ["mit"], True),
        (" mit or gpl-2.0-only and apache-2.0", ["apache-2.0", "gpl-2.0-only", "mit"], True),
        (" (mit or gpl-2.0-only) and gpl-3.0-or-later", ["gpl-2.0-only", "gpl-3.0-or-later", "mit"], False),
        (" gpl-2.0-or-later with classpath-exception-2.0 or mit", ["gpl-2.0-or-later", "mit"], True),
        (" mit and (bsd-3-clause or (isc and zlib)) trailing words", ["bsd-3-clause", "isc", "mit", "zlib"], True),
        (" mit and", ["mit"], True),
        (" mit or (apache-2.0 and", ["mit"], True),
        (" apache-2.0.", ["apache-2.0"], True),
    ],
)
def test_expressions(line, labels, permissive):
    assert meaning(line) == (labels, permissive)


def test_no_expression():
    for line in ("", " ", " and mit", " )", " (mit", " ((mit or isc)", " with mit", " , mit"):
        assert tokens(line) == []
    assert tokens(" see the file", False) == []
    assert tokens(" mit license", False) == ["mit"]
    assert tokens(" mit with (a)") == ["mit"]
    assert tokens(" (mit) with x") == ["(", "mit", ")"]


def test_postfix_binds_with_then_and_then_or():
    assert scans.postfix("a or b and c with d or e".split()) == "a b c d with and or e or".split()


def test_tags_read_their_own_line_only():
    _, _, found, score = scans.scan("x\nSPDX-License-Identifier: MIT OR\nGPL-2.0\nLicense: see file\nlicense: Apache-2.0 license: ISC")
    assert [e[1] for e in found] == ["mit", "apache-2.0", "isc"]
    assert score > 0.99


def test_long_hard_texts_are_linear():
    for text in ("license: " * 60_000, "spdx-license-identifier: (" * 40_000, "spdx-license-identifier: " + " and ".join(f"a{k}" for k in range(100_000)), "cc by " * 200_000, "(" * 10**6):
        n, spans, found, _ = scans.scan(text)
        assert n == len(words(text))
    assert len(scans.scan("cc by " * 1000)[1]) == 1000


def test_query_rows(spark, tmp_path):
    texts = [(1, None), (2, ""), (None, "All rights reserved"), (4, "CC BY, cc-by! general public license"), (4, "x"), (5, "Licensed under MIT or (GPL-2.0-only and ISC)."), (6, "€ CC BY\x85é")]
    rows = [(i, t, "w", 5, "s") for i, t in texts]
    spark.createDataFrame(rows, "doc_id bigint, text string, words string, n_words int, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_license_scan"](spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    by_text = {(r.doc_id, r.n_words): r for r in got}
    for i, t in texts:
        r, base = by_text[(i, len(words(t)))], places(t, scans.BASE)
        starts = [k for k, _ in base]
        assert (r.n_base, r.first_word, r.last_word) == (len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert by_text[(5, 10)].labels == "gpl-2.0-only,isc,mit" and by_text[(5, 10)].permissive
    assert by_text[(1, 0)].labels == "" and by_text[(1, 0)].score == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert scans.scan_licenses(empty).count() == 0
