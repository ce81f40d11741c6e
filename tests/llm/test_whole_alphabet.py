"""Quality rules know the letters of all scripts."""

import pytest

from timeline_engine.llm import quality_rules as Q

NAMES = [r[0] for r in Q.RULES]


def value(text, rule):
    return Q.measure(text, Q._class_tables(), frozenset())[1][NAMES.index(rule)]


@pytest.mark.parametrize("text", ["\u2022 \u2014 \u201c \u2026", "\u2500\u2500 \u2502", "\U0001f600 \U0001f680\U0001f680", "\u3002 \u3001", "\u2167 \u24b6"])
def test_marks_are_no_letters(text):
    assert value(text, "share of words with a letter") == 0
    assert value(text, "share of upper-case letters") is None


@pytest.mark.parametrize("text, upper", [("\u0391\u0392\u0393 \u0394\u0395", 1), ("\u041c\u0418\u0420 \u043c\u0438\u0440", 0.5), ("\u4e2d\u6587 \u6587", 0), ("ABc \u00c9", 0.75), ("\U00010400\U00010428", 0.5)])
def test_letters_of_all_scripts(text, upper):
    assert value(text, "share of words with a letter") == 1
    assert value(text, "share of upper-case letters") == upper
