"""Extraction keeps the article's text around and inside embedded elements."""

import pytest

from timeline_engine.llm import html_crf

BEFORE, AFTER = "The first paragraph says a thing or two.", "The last paragraph says some more of it."
EMBEDDED = ["noscript", "svg", "math", "object", "canvas", "audio", "video"]


def article(inside):
    return f"<html><body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>{BEFORE}</p>{inside}<p>{AFTER}</p></article><footer>&copy; site</footer></body></html>"


@pytest.mark.parametrize("tag", EMBEDDED)
@pytest.mark.parametrize("form", ["<{0} class=x>", "<p>In the <{0}> middle of it.</p>", "<figure><{0} src=x></figure>"])
def test_text_after_an_unclosed_element(tag, form):
    lines = html_crf.trained_field().extract(article(form.format(tag))).split("\n")
    assert lines[:2] == ["A title", BEFORE] and lines[-1] == AFTER
    assert ("middle" in form) == ("In the middle of it." in lines)


def test_text_inside_embedded_elements():
    field = html_crf.trained_field()
    formula = "<p>We know that <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds here.</p>"
    assert "We know that a=2 holds here." in field.extract(article(formula)).split("\n")
    fallback = "<p>A chart: <object data=c.pdf>sales rose by a tenth</object> in a year.</p>"
    assert "A chart: sales rose by a tenth in a year." in field.extract(article(fallback)).split("\n")


def test_a_title_in_svg_does_not_end_the_paragraph():
    found = html_crf.blocks("<article><p>One <svg><title>icon</title><path d='M0'/></svg> two</p></article>")
    assert [(b.text, [e[0] for e in b.path]) for b in found] == [("One", ["article", "p", "svg"]), ("icon", ["article", "p", "svg", "title"]), ("two", ["article", "p"])]


@pytest.mark.parametrize("tag", ["script", "style", "template", "iframe", "textarea"])
def test_raw_elements_are_no_text(tag):
    lines = html_crf.trained_field().extract(article(f"<{tag}><p>Never a text of the page.</p></{tag}>")).split("\n")
    assert lines == ["A title", BEFORE, AFTER]
