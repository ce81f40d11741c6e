"""Licence scans: Aho-Corasick for notices and tags, a shunting-yard parser for
licence expressions.

One automaton runs over the words of a text (lower-cased, one space between
words) and finds every notice phrase whose words stand consecutively. A second
one runs over the lower-cased text as it stands and finds identifier tags; the
rest of a tag's line is read as a licence expression (operands, AND, OR, WITH,
parentheses). The longest beginning that is a whole expression is turned into
postfix order by operator precedence (WITH binds closest, then AND, then OR) and
evaluated twice: to the set of licences it names, and to whether a policy that
allows ``PERMISSIVE`` families alone can be met.

An operand is a licence by rule (``IDENTIFIER``); after the tags of ``OPEN_TAGS``
any well-formed operand counts. An exception after WITH labels nothing.

The score is one minus the product of one minus the strength of each distinct
piece of evidence.

Scale: a scan with no shuffle. Automata are built once per worker from fixed
lists. Time is linear in the text: each text is scanned once by either
automaton, and expressions of one line don't overlap.

Nulls: a null text is empty: no words, no labels, score 0. Rows that repeat a
doc_id are scanned each by its own text, a null doc_id is kept. Other columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table

#: Phrases that every scan looks for: words and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices: words -> (label, strength).
NOTICES = {
    "mit license": ("mit", 0.8),
    "permission is hereby granted free of charge to any person": ("mit", 0.9),
    "apache license": ("apache", 0.8),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "bsd license": ("bsd", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "isc license": ("isc", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "general public license version 2": ("gpl-2.0", 0.9),
    "general public license version 3": ("gpl-3.0", 0.9),
    "boost software license": ("bsl", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc by nc sa": ("cc-by-nc-sa", 0.8),
    "cc by nc nd": ("cc-by-nc-nd", 0.8),
    "cc0": ("cc0", 0.6),
    "dedicated to the public domain": ("public-domain", 0.8),
    "released into the public domain": ("public-domain", 0.8),
    "without warranty of any kind": ("no-warranty", 0.5),
    "provided as is without warranty": ("no-warranty", 0.5),
    "used with permission": ("permission", 0.4),
}
BASE_STRENGTH, TAG_STRENGTH = 0.7, 0.95
#: Tags after which any operand is a licence, and those that need a known one.
OPEN_TAGS = ("spdx-license-identifier:",)
KNOWN_TAGS = ("license:", "licence:", "licensed under", "@license", "license-expression:", "license ::")
#: Operands that are licences by their form.
IDENTIFIER = re.compile(
    r"mit(-0)?|isc|zlib|unlicense|0bsd|bsd-[1-4]-clause(-[a-z]+)?|apache-[12]\.[01]|[al]?gpl-[1-3]\.[0-2](-only|-or-later)?\+?"
    r"|mpl-[12]\.[01](-no-copyleft-exception)?|epl-[12]\.0|cddl-1\.[01]|bsl-1\.0|artistic-[12]\.0|python-2\.0|cc0-1\.0"
    r"|cc-by(-nc)?(-sa|-nd)?-[1-4]\.[05]|ofl-1\.[01]|wtfpl|eupl-1\.[0-2]|licenseref-[a-z0-9.-]+"
)
PERMISSIVE = re.compile(r"mit|isc|zlib|unlicense|0bsd|bsd|apache|bsl|python|cc0|cc-by-[1-4]")
_TOKEN = re.compile(r"[ \t]*([a-z0-9][a-z0-9.+-]*|[()])")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Texts in one Arrow batch.
TEXT_ROWS = 2_000
_NO_WORD = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
_SPAN = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
_EXPRESSION = pa.struct([("at", pa.int64()), ("text", pa.string()), ("postfix", pa.string()), ("labels", pa.string()), ("permissive", pa.bool_())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("expressions", pa.list_(_EXPRESSION)), ("score", pa.float64())])
SCHEMA = (
    "doc_id bigint, n_words bigint, spans array<struct<first_word: bigint, n_words: bigint, label: string, base: boolean>>, "
    "expressions array<struct<at: bigint, text: string, postfix: string, labels: string, permissive: boolean>>, score double"
)


@lru_cache(1)
def automata():
    """(of phrases between spaces, of tags)."""
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    found: dict[str, list[tuple[int, str, bool, float]]] = {}
    for words, label in BASE.items():
        found.setdefault(words, []).append((words.count(" ") + 1, label, True, BASE_STRENGTH))
    for words, (label, strength) in NOTICES.items():
        found.setdefault(words, []).append((words.count(" ") + 1, label, False, strength))
    for words, what in found.items():
        phrases.add_word(f" {words} ", (len(words) + 1, what))
    for tag in (*OPEN_TAGS, *KNOWN_TAGS):
        tags.add_word(tag, tag in OPEN_TAGS)
    for a in (phrases, tags):
        a.make_automaton()
    return phrases, tags


def whole_expression(text: str, at: int, end: int, any_operand: bool) -> tuple[list[str], int]:
    """(tokens, end) of the longest expression that begins at ``at`` and ends
    before ``end``; no tokens if there is none."""
    tokens, whole, depth, after, operand_next = [], 0, 0, at, True
    while m := _TOKEN.match(text, at, end):
        token, at = m[1], m.end()
        after_with = bool(tokens) and tokens[-1] == "with"
        if operand_next:
            if token == "(" and not after_with:
                depth += 1
            elif token in PRECEDENCE or token in "()":
                break
            else:
                bare = token.rstrip(".-") or token
                if not (after_with or any_operand or IDENTIFIER.fullmatch(bare)):
                    break
                token, operand_next = bare, False
        elif token == ")" and depth:
            depth -= 1
        elif token in PRECEDENCE and not (token == "with" and (tokens[-1] == ")" or len(tokens) > 1 and tokens[-2] == "with")):
            operand_next = True  # WITH follows a licence, not a group or another WITH
        else:
            break
        tokens.append(token)
        if not operand_next and not depth:
            whole, after = len(tokens), at
    return tokens[:whole], after


def postfix(tokens: list[str]) -> list[str]:
    """A whole expression in postfix order, by the shunting-yard rule."""
    out, held = [], []
    for token in tokens:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
        else:
            out.append(token)
    return out + held[::-1]


def evaluate(tokens: list[str]) -> tuple[set[str], bool]:
    """(licences named, whether permissive ones suffice) of a postfix expression."""
    stack: list[tuple[set[str], bool]] = []
    for token in tokens:
        if token not in PRECEDENCE:
            stack.append(({token}, bool(PERMISSIVE.match(token))))
            continue
        (right, y), (left, x) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, x))
            continue
        more, fewer = (left, right) if len(left) > len(right) else (right, left)
        more |= fewer  # in place: a long chain stays linear
        stack.append((more, x and y if token == "and" else x or y))
    return stack[0]


def scan(text: str | None) -> tuple[int, list[tuple], list[tuple], float]:
    """(number of words, spans, expressions, score) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    words = raw.translate(_NO_WORD).split()
    if not words:
        return 0, [], [], 0.0
    phrases, tags = automata()
    spaced = f" {b' '.join(words).decode('latin-1')} "
    spans, evidence = [], {}
    word, seen = 0, 0
    for end, (length, what) in phrases.iter(spaced):
        # The phrase begins after the space at end - length; matches come by
        # their ends, so starts may step back by a phrase at most.
        start = end - length
        word += spaced.count(" ", seen, start) if start >= seen else -spaced.count(" ", start, seen)
        seen = start
        for n, label, base, strength in what:
            spans.append((word, n, label, base))
            evidence[label] = max(evidence.get(label, 0.0), strength)
    as_is, expressions, done, line_end = raw.decode("latin-1"), [], 0, 0
    for end, open_ in tags.iter(as_is):
        if end < done:
            continue  # inside an expression already read
        if line_end <= end:
            line_end = as_is.find("\n", end + 1)
            line_end = line_end if line_end >= 0 else len(as_is)
        tokens, after = whole_expression(as_is, end + 1, line_end, open_)
        if not tokens:
            continue
        turned, done = postfix(tokens), after
        labels, permissive = evaluate(turned)
        expressions.append((end + 1, " ".join(tokens), " ".join(turned), ",".join(sorted(labels)), permissive))
        for label in labels:
            evidence[label] = TAG_STRENGTH
    doubt = 1.0
    for label in sorted(evidence):
        doubt *= 1.0 - evidence[label]
    return len(words), sorted(spans), expressions, 1.0 - doubt


def _scan_batches(batches):
    for batch in batches:
        found = [scan(t.as_py()) for t in batch.column(1)]
        n, spans, expressions, score = zip(*found, strict=True) if found else ((), (), (), ())
        dicts = lambda rows, kind: pa.array([[dict(zip((f.name for f in kind), r, strict=True)) for r in x] for x in rows], pa.list_(kind))
        arrays = [batch.column(0), pa.array(n, pa.int64()), dicts(spans, _SPAN), dicts(expressions, _EXPRESSION), pa.array(score, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, spans, expressions, score), one row a document: every
    place of a notice by its first word, and every expression after a tag with
    its place in the text (bytes), postfix form, licences and policy verdict."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scan_batches, SCHEMA)


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: base phrases, first and last place, labels, score."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    of_spans = lambda spans: F.transform(spans, lambda s: s["label"])
    tagged = F.flatten(F.transform("expressions", lambda e: F.split(e["labels"], ",")))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(of_spans(base)).alias("base_labels"),
        joined(F.concat(of_spans(F.col("spans")), tagged)).alias("labels"),
        "score",
        F.transform("expressions", lambda e: e["text"]).alias("expressions"),
        F.coalesce(F.exists("expressions", lambda e: e["permissive"]), F.lit(False)).alias("permissive"),
    )
