"""Extraction against an independent reader of all pages, and in linear time."""

import time
from html.parser import HTMLParser

import pytest

from timeline_engine.llm import html_crf


class Article(HTMLParser):
    """The text inside <article>, but for adverts, by block tags."""

    BLOCKS = {"p", "h1", "h2", "h3", "li", "ul", "ol", "div", "article", "blockquote", "table", "tr", "td", "pre"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.parts, self.inside, self.adverts = [], [], 0, 0

    def cut(self):
        line = " ".join("".join(self.parts).split())
        if line:
            self.lines.append(line)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.cut()
        if tag == "br":
            self.parts.append(" ")
        self.inside += tag == "article"
        if tag == "div" and (self.adverts or dict(attrs).get("class") == "ad"):
            self.adverts += 1

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.cut()
        self.inside -= tag == "article"
        self.adverts -= tag == "div" and self.adverts > 0

    def handle_data(self, data):
        if self.inside and not self.adverts:
            self.parts.append(data)


def independent(page):
    reader = Article()
    reader.feed(page or "")
    reader.close()
    reader.cut()
    return "\n".join(reader.lines)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_all_pages_equal_an_independent_reading(spark, sf):
    d = f"/root/testdata/{sf}"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = html_crf.op1_html_extraction(spark, d).collect()
    assert len(rows) == len(html)
    assert [r.page_id for r in rows if r.text != independent(html[r.page_id]) or r.n_chars != len(r.text)] == []


LONG = {
    "open tags without an end": "<p " * 700_000,
    "quotes without an end": "<a b='" * 300_000,
    "quoted marks": "<p ''" * 300_000 + "'>",
    "declarations": "<!" * 500_000,
    "nested divisions": "<div>a" * 200_000,
    "end tags that fit nothing": "<div>a" * 100_000 + "</section>" * 100_000,
    "inline elements around a block": "<i><div>" + "<b>" * 200_000 + "</i>" * 200_000,
    "a script without an end": "<script>" + "</script " * 200_000,
    "a number reference of a million digits": "<article><p>&#" + "9" * 1_000_000 + "; &#" + "0" * 9_000 + "65;",
}


@pytest.mark.parametrize("name", LONG)
def test_linear_time(name):
    field = html_crf.trained_field()
    began = time.time()
    assert isinstance(field.extract(LONG[name]), str)
    assert time.time() - began < 30


def test_number_references():
    page = "<article><p>" + "word " * 30 + "&#0065;&#x41;&#" + "0" * 5_000 + "66;&#" + "7" * 5_000 + ";.</p></article>"
    assert html_crf.trained_field().extract(page).endswith(" AAB�.")
