"""Main-text extraction: a linear-chain conditional random field over the DOM's
leaf blocks.

A page is cut into blocks at block-level tags; each block carries its text and
the open elements above it. Features of a block are its ancestors' tags, the
kinds of names in their class, id and role attributes, and properties of its
text (length, link density, closing mark, place in the page). The field scores
labels content / other by these features and by the label of the block before;
Viterbi decoding picks the best sequence, and the content blocks are the text.

The field is trained by Adam on the exact conditional log-likelihood, on
labelled pages that ``labelled_pages`` makes: layouts of many kinds (semantic
tags or plain divisions, tables, lists, sidebars, notices, adverts inside the
article, forms, reader comments) over invented words, so no feature can lean on
vocabulary. Training takes a few seconds on the driver and is deterministic;
the weights (a few hundred numbers) travel with the task.

Nulls: a null or empty page has an empty text. Broken markup is read leniently:
unmatched end tags are ignored, open elements end with their parent or with the
page. Text in math, svg, object, noscript, canvas, audio and video (formulas,
fallbacks) is text of its block like any other. Repeated rows
give repeated rows, an empty table an empty table; other columns are ignored.
"""

from __future__ import annotations

import html as html_module
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

OTHER, CONTENT = 0, 1
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is never text of the page; one without an end tag
#: reaches to the end of the page, by HTML's rule.
RAW_TAGS = frozenset("script style template iframe textarea".split())
#: start tag -> open elements that it ends, and those that hide them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "title": (frozenset(), frozenset()),  # in svg it stands inside a paragraph
}
_P_KEEPERS = frozenset("button td th table body html object foreignobject".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[>\"']")
_NUMBER = re.compile("&#0*([0-9]+)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
#: Kinds of names in class, id and role attributes.
KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toc tabs toolbar skip",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adsbygoogle teaser",
    "side": "sidebar side aside widget related recommended recommendations popular trending more complementary rail",
    "comment": "comment comments disqus reply replies respond discussion feedback",
    "notice": "cookie cookies consent notice gdpr alert newsletter subscribe popup modal overlay message warning paywall",
    "edge": "footer header masthead copyright legal contentinfo bottom top colophon",
    "share": "share sharing social follow",
    "form": "form login search signup register contact",
    "content": "content article post entry main story text body prose",
}
_KIND_OF = {name: kind for kind, names in KINDS.items() for name in names.split()}
_OWN_TAGS = frozenset("p h1 h2 h3 h4 li td th div blockquote pre dd dt figcaption body title".split())
_PATH_TAGS = frozenset("nav header footer aside article main section form ul ol table head title figure button select dialog address details".split())


class Path:
    """A place inside an open element. Of the elements above it only what the
    field reads is kept, of bounded size however deep they are nested."""

    __slots__ = ("parent", "tag", "read")
    #: what an element chain shows -> its features; emptied when large
    _features: dict[tuple, list[str]] = {}

    def __init__(self, parent: Path | None = None, element: tuple = ("", (), False)):
        self.parent, (tag, kinds, hidden) = parent, element
        self.tag = tag
        if parent is None:
            self.read = (frozenset(), "none", frozenset(), (), False, None, 0)
            return
        above, own, seen, near, unseen, head, articles = parent.read
        if tag in _PATH_TAGS:
            if tag == "header" and head is None:
                head = "header in article" if articles else "header of page"
            articles = min(2, articles + (tag == "article"))
            above = above | {tag}
        self.read = (above, tag if tag in BLOCK_TAGS else own, seen.union(kinds) if kinds else seen, kinds or near, unseen or hidden, head, articles)

    def __iter__(self):
        """The elements above, as (tag,), outermost first."""
        tags, place = [], self
        while place.parent is not None:
            tags.append((place.tag,))
            place = place.parent
        return reversed(tags)

    def features(self) -> list[str]:
        known = Path._features.get(self.read)
        if known is not None:
            return known
        above, own, seen, near, hidden, head, articles = self.read
        out = ["above:" + t for t in above]
        out.append("own:" + (own if own in _OWN_TAGS else "rest"))
        out += ["kind:" + k for k in seen]
        out += ["near:" + k for k in near]
        if hidden:
            out.append("hidden")
        if head:
            out.append(head)
        if articles > 1:
            out.append("nested article")
        if above & {"ul", "ol"} and not above & {"article", "main"}:
            out.append("list outside article")
        if not above & {"article", "main"} and "content" not in seen:
            out.append("no main part above")
        if len(Path._features) > 20_000:
            Path._features.clear()
        Path._features[self.read] = out
        return out


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: Path, linked: int):
        self.text, self.path, self.linked = text, path, linked


_ELEMENTS: dict[tuple[str, str], tuple] = {}  # emptied when large


def _element(tag: str, attributes: str) -> tuple[str, tuple[str, ...], bool]:
    """(tag, kinds named, hidden) of a start tag."""
    known = _ELEMENTS.get((tag, attributes))
    if known is not None:
        return known
    if len(_ELEMENTS) > 20_000:
        _ELEMENTS.clear()
    kinds, hidden = [], False
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id", "role"):
                kinds += [k for k in map(_KIND_OF.get, _NAME.findall(value)) if k]
            elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "") or name == "aria-hidden" and value == "true":
                hidden = True
    found = _ELEMENTS[tag, attributes] = (tag, tuple(dict.fromkeys(kinds)), hidden)
    return found


class _Tags:
    """Finds the markup of a page from left to right in linear time.

    A tag ends at the first ``>`` outside quotes. Where each mark leads is kept,
    so that the page is not read again for every ``<`` that begins no tag.
    """

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}  # mark -> end of a tag that meets it, -1 if none
        self.from_, self.mark = 0, -1  # the first mark from ``from_`` on
        self.last_close = page.rfind(">")

    def _first_mark(self, at: int) -> int:
        if not self.from_ <= at <= self.mark:
            m = _MARK.search(self.page, at)
            self.from_, self.mark = at, m.start() if m else len(self.page)
        return self.mark

    def _tag_end(self, at: int) -> int:
        page, ends, met = self.page, self.ends, []
        mark, n = self._first_mark(at), len(page)
        while True:
            if mark >= n:
                end = -1
                break
            end = ends.get(mark)
            if end is not None:
                break
            met.append(mark)
            if page[mark] == ">":
                end = mark + 1
                break
            close = page.find(page[mark], mark + 1)
            if close < 0:
                end = -1
                break
            m = _MARK.search(page, close + 1)
            mark = m.start() if m else n
        for k in met:
            ends[k] = end
        return end

    def next(self, at: int):
        """(start, end, slash, tag, attributes) of the next markup; the tag is
        None for comments and declarations. None if there is no more."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            kind = page[start + 1 : start + 2]
            if kind in ("!", "?"):
                if page.startswith("<!--", start):
                    close = page.find("-->", start + 4)
                    return start, close + 3 if close >= 0 else len(page), "", None, ""
                if start < self.last_close and (close := page.find(">", start)) >= 0:
                    return start, close + 1, "", None, ""
            elif m := _TAG.match(page, start):
                end = self._tag_end(m.end())
                if end >= 0:
                    return start, end, m[1], m[2].lower(), page[m.end() : end - 1]
            at = start + 1
        return None


def _unescaped(text: str) -> str:
    """``text`` with character references decoded, numbers of any length."""
    if "&#" in text:  # beyond the last code point they all mean the same
        text = _NUMBER.sub(lambda m: "&#" + (m[1] if len(m[1]) < 9 else "1114112"), text)
    return html_module.unescape(text)


def blocks(page: str) -> list[Block]:
    """The non-empty leaf blocks of a page, in order, in time linear in its
    length: open elements are found by their places, kept per tag."""
    found, parts, linked, at, n = [], [], 0, 0, len(page)
    tags, stack, paths = _Tags(page), [], [Path()]  # paths[k]: inside the first k open elements
    places: dict[str, list[int]] = {}  # tag -> its places in the stack
    block_places: list[int] = []

    def flush():
        nonlocal parts, linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = _unescaped(text)
            text = " ".join(text.split())
            if text:
                found.append(Block(text, paths[-1], linked))
            parts, linked = [], 0

    def last(names) -> int:
        return max((places[t][-1] for t in names if places.get(t)), default=-1)

    def pop_to(k: int):
        for tag in stack[k:]:
            places[tag].pop()
        while block_places and block_places[-1] >= k:
            block_places.pop()
        del stack[k:], paths[k + 1 :]

    while at < n:
        token = tags.next(at)
        end = token[0] if token else n
        if end > at:
            parts.append(page[at:end])
            if places.get("a"):
                linked += end - at
        if token is None:
            break
        _, at, slash, tag, attributes = token
        if tag is None:
            continue
        if slash:
            if tag in BLOCK_TAGS:
                flush()
            elif tag == "br":
                parts.append(" ")
            k = last((tag,))
            # An end tag inside a block does not end what is open around it.
            if k >= 0 and (tag in BLOCK_TAGS or not block_places or block_places[-1] < k):
                pop_to(k)
            continue
        if tag in RAW_TAGS:
            if not attributes.endswith("/") or tag != "template":
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                close = page.find(">", close.end()) if close else -1
                at = close + 1 if close >= 0 else n
            continue
        if tag in BLOCK_TAGS:
            flush()
            ends, keeps = _ENDS.get(tag, (None, None))
            if ends is None and tag not in VOID_TAGS or tag == "hr":
                ends, keeps = {"p"}, _P_KEEPERS
            k = last(ends)
            if k > last(keeps):
                pop_to(k)
        elif tag == "br":
            parts.append(" ")
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK_TAGS:
                block_places.append(len(stack))
            stack.append(tag)
            paths.append(Path(paths[-1], _element(tag, attributes)))
    flush()
    return found


def features(page_blocks: list[Block]) -> list[list[str]]:
    """The feature names of each block."""
    out, n = [], len(page_blocks)
    for i, b in enumerate(page_blocks):
        words, length = b.text.count(" ") + 1, max(len(b.text), 1)
        size = 0 if words == 1 else 1 if words < 5 else 2 if words < 10 else 3 if words < 20 else 4 if words < 50 else 5
        density = b.linked / length
        names = ["bias", *b.path.features(), f"words:{size}", f"links:{0 if not density else 1 if density < 0.3 else 2 if density < 0.8 else 3}"]
        if b.text[-1] in ".!?…:;\"”»)":
            names.append("closing mark")
        if "©" in b.text or "(c)" in b.text.lower():
            names.append("copyright")
        place = 10 * i // n
        names.append("place:" + ("first" if place == 0 else "last" if place == 9 else "middle"))
        out.append(names)
    return out


class Field:
    """Weights: feature -> (other, content); transitions [before, now]; start."""

    def __init__(self, weights: dict[str, tuple[float, float]], moves: list[list[float]], start: list[float]):
        self.weights, self.moves, self.start = weights, moves, start

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best label sequence (Viterbi)."""
        if not rows:
            return []
        w, ((m00, m01), (m10, m11)) = self.weights, self.moves
        back, a, b = [], self.start[0], self.start[1]
        for i, names in enumerate(rows):
            x = y = 0.0
            for f in names:
                v = w.get(f)
                if v is not None:
                    x += v[0]
                    y += v[1]
            if i:
                p, q, r, s = a + m00, b + m10, a + m01, b + m11
                back.append((q > p, s > r))
                a, b = max(p, q) + x, max(r, s) + y
            else:
                a, b = a + x, b + y
        label = CONTENT if b > a else OTHER
        labels = [label]
        for choice in reversed(back):
            label = int(choice[label])
            labels.append(label)
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        found = blocks(page)
        labels = self.decode(features(found))
        return "\n".join(b.text for b, y in zip(found, labels, strict=True) if y == CONTENT)


def _forward(scores: np.ndarray, moves: np.ndarray, start: np.ndarray, mask: np.ndarray):
    """Posteriors of labels and of label pairs, by forward-backward over padded
    sequences: scores [page, block, label], mask [page, block]."""
    n, length, _ = scores.shape
    alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    alpha[:, 0] = scores[:, 0] + start
    for t in range(1, length):
        step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(moves[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(mask[:, t + 1, None], step, beta[:, t + 1])
    total = np.logaddexp.reduce(alpha[:, -1], axis=1)
    single = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
    pair = np.exp(alpha[:, :-1, :, None] + moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
    return single, pair


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 150, ridge: float = 2e-3) -> Field:
    """A field fitted to labelled pages: (features of blocks, labels)."""
    pages = [p for p in pages if p[1]]
    index: dict[str, int] = {}
    length = max(len(y) for _, y in pages)
    mask, truth = np.zeros((len(pages), length), bool), np.zeros((len(pages), length), int)
    cell, column = [], []
    for i, (rows, y) in enumerate(pages):
        mask[i, : len(y)], truth[i, : len(y)] = True, y
        for t, names in enumerate(rows):
            for f in names:
                cell.append(i * length + t)
                column.append(index.setdefault(f, len(index)))
    cell, column, k = np.array(cell), np.array(column), len(index)
    gold = np.eye(2)[truth] * mask[:, :, None]
    gold_pair = np.zeros((2, 2))
    np.add.at(gold_pair, (truth[:, :-1][mask[:, 1:]], truth[:, 1:][mask[:, 1:]]), 1)
    theta = np.zeros(2 * k + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, moves, start = theta[: 2 * k].reshape(k, 2), theta[2 * k : 2 * k + 4].reshape(2, 2), theta[2 * k + 4 :]
        scores = np.stack([np.bincount(cell, w[column, c], mask.size) for c in (0, 1)], -1).reshape(*mask.shape, 2)
        single, pair = _forward(scores, moves, start, mask)
        off = (single - gold).reshape(-1, 2)
        grad = np.concatenate(
            [np.stack([np.bincount(column, off[cell, c], k) for c in (0, 1)], -1).ravel(), (pair.sum((0, 1)) - gold_pair).ravel(), (single[:, 0] - gold[:, 0]).sum(0)]
        ) / len(pages) + ridge * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta = theta - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w = theta[: 2 * k].reshape(k, 2)
    return Field({f: (float(w[j, 0]), float(w[j, 1])) for f, j in index.items()}, theta[2 * k : 2 * k + 4].reshape(2, 2).tolist(), theta[2 * k + 4 :].tolist())


class _Layout:
    """Makes one labelled page. Text that belongs to the article is wrapped in
    a private-use mark, which gives the labels and is then removed."""

    MARK = ""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.semantic = rng.random() < 0.6

    def words(self, low: int, high: int) -> str:
        r = self.rng
        return " ".join("".join(r.choice("abdeghilmnorstuwyéäñ") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        text = ". ".join(self.words(4, 14).capitalize() for _ in range(self.rng.randint(low, high)))
        return text + self.rng.choice([".", ".", ".", "!", "?", ""])

    def link(self) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>'

    def body(self, tag: str, text: str) -> str:
        r = self.rng
        if r.random() < 0.15:
            first, _, rest = text.partition(" ")
            text = f"{first} {r.choice(['<b>', '<em>', '<a href=/x>'])}{rest}" + r.choice(["", "<br>"])
        return f"<{tag}>{self.MARK}{text}" + ("" if r.random() < 0.1 else f"</{tag}>")

    def box(self, tags: str, names: str, inside: str) -> str:
        """``inside`` in a semantic element, or in a division with a telling
        name, or in both."""
        r = self.rng
        tag = r.choice(tags.split()) if tags and (self.semantic or r.random() < 0.3) else "div"
        name = f' {r.choice(["class", "class", "id"])}="{r.choice(names.split())}"' if tag == "div" or r.random() < 0.5 else ""
        return f"<{tag}{name}>{inside}</{tag}>"

    def menu(self) -> str:
        r = self.rng
        items = [self.link() for _ in range(r.randint(2, 9))]
        if r.random() < 0.7:
            inside = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        else:
            inside = r.choice([" | ", " "]).join(items)
        return self.box("nav", "nav menu navbar main-nav breadcrumb pagination site-menu", inside)

    def advert(self) -> str:
        r = self.rng
        text = self.sentences(1, 3)
        inside = text if r.random() < 0.6 else f"<p>{text}</p>" if r.random() < 0.5 else f"{text} {self.link()}"
        return f'<{(t := r.choice(["div", "div", "aside", "section"]))} {r.choice(["class", "id"])}="{r.choice("ad ads advert banner sponsored promo ad-slot ad-box".split())}">{inside}</{t}>'

    def notice(self) -> str:
        names = "cookie-notice consent alert newsletter subscribe gdpr-popup notice modal"
        return self.box("", names, f"<p>{self.sentences(1, 2)}</p>" + self.rng.choice(["", f"<button>{self.words(1, 2)}</button>"]))

    def form(self) -> str:
        text = f"<label>{self.words(1, 3)}</label><input name=q><p>{self.sentences(1, 1)}</p><button>{self.words(1, 2)}</button>"
        return f"<form{self.rng.choice(['', ' class=search', ' id=login-form'])}>{text}</form>"

    def sidebar(self) -> str:
        r = self.rng
        parts = [f"<h3>{self.words(1, 3)}</h3>"]
        parts += [f"<p>{self.sentences(1, 3)}</p>" if r.random() < 0.4 else f"<ul><li>{self.link()}</li><li>{self.link()}</li></ul>" for _ in range(r.randint(1, 3))]
        return self.box("aside", "sidebar side widget related popular recommended", "".join(parts))

    def comments(self) -> str:
        r = self.rng
        one = lambda: r.choice(
            [
                f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p></div>',
                f'<article class="comment"><p>{self.sentences(1, 4)}</p></article>',
                f"<li><p>{self.sentences(1, 4)}</p></li>",
                f"<p>{self.sentences(1, 4)}</p>",
            ]
        )
        inside = f"<h3>{self.words(1, 3)}</h3>" + "".join(one() for _ in range(r.randint(1, 5)))
        t = r.choice(["section", "div", "div", "ol"])
        return f'<{t} {r.choice(["class", "id"])}="{r.choice("comments comment-list reader-comments discussion replies".split())}">{inside}</{t}>'

    def head(self, title: str) -> str:
        inside = f"<{(t := self.rng.choice(['a', 'span', 'div', 'p', 'h2']))}>{self.words(1, 4)}</{t}>" + (self.menu() if self.rng.random() < 0.5 else "")
        return self.box("header", "header masthead top site-header page-header", inside)

    def foot(self) -> str:
        r = self.rng
        text = r.choice(["&copy; ", "© ", ""]) + self.words(1, 3) + r.choice([" &middot; ", " "]) + self.sentences(1, 2)
        return self.box("footer", "footer site-footer copyright legal colophon", r.choice([text, f"<p>{text}</p>", f"<p>{text}</p><ul><li>{self.link()}</li></ul>"]))

    def article(self, title: str) -> str:
        r = self.rng
        parts = []
        if r.random() < 0.85:
            top = self.body("h1", title)
            parts.append(f"<header>{top}</header>" if self.semantic and r.random() < 0.2 else top)
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            x = r.random()
            if x < 0.72:
                parts.append(self.body("p", self.sentences(1, 7) if r.random() < 0.7 else self.words(1, 8) + r.choice([".", ""])))
            elif x < 0.8:
                parts.append(self.body(r.choice(["h2", "h3"]), self.words(1, 6)))
            elif x < 0.87:
                parts.append("<ul>" + "".join(self.body("li", self.words(1, 12)) for _ in range(r.randint(1, 5))) + "</ul>")
            elif x < 0.91:
                parts.append(f"<blockquote>{self.body('p', self.sentences(1, 3))}</blockquote>")
            elif x < 0.94:
                parts.append("<table><tr>" + "".join(self.body("td", self.words(1, 4)) for _ in range(3)) + "</tr></table>")
            elif x < 0.96:
                parts.append(self.body("pre", self.words(3, 20)))
            else:
                parts.append(self.body("div", self.sentences(1, 4)))
        for make, p in ((self.advert, 0.3), (self.sidebar, 0.08), (self.form, 0.08), (self.notice, 0.08), (self.menu, 0.08)):
            if r.random() < p:
                parts.insert(r.randint(0, len(parts)), make())
        if r.random() < 0.15:
            parts.append(self.box("", "share social-links follow", f"{self.words(1, 2)} {self.link()} {self.link()}"))
        if r.random() < 0.15:
            parts.append(self.comments())
        return self.box("article main article", "content post article entry post-body article-content story main-text", "".join(parts))

    def page(self) -> str:
        r = self.rng
        title = self.words(2, 9).capitalize()
        before, after = [], [self.foot()]
        for make, p in ((lambda: self.head(title), 0.6), (self.menu, 0.8), (self.notice, 0.35), (self.advert, 0.4), (self.form, 0.2), (self.sidebar, 0.3)):
            if r.random() < p:
                before.append(make())
        for make, p in ((self.comments, 0.35), (self.sidebar, 0.35), (self.menu, 0.25), (self.advert, 0.25), (self.form, 0.2), (self.notice, 0.15)):
            if r.random() < p:
                after.insert(0, make())
        middle = self.article(title)
        if r.random() < 0.25:
            middle = self.box("main", "wrapper container page", middle)
        head = f'<head><meta charset="utf-8"><title>{title}</title><style>p{{}}</style></head>'
        return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{middle}{''.join(after)}</body></html>"


def labelled_pages(n: int, seed: int = 7) -> list[tuple[list[list[str]], list[int]]]:
    """(features of blocks, labels) of invented pages."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        found = blocks(_Layout(rng).page())
        labels = [CONTENT if _Layout.MARK in b.text else OTHER for b in found]
        for b in found:
            b.text = b.text.replace(_Layout.MARK, "")
        out.append((features(found), labels))
    return out


@lru_cache(1)
def trained_field(n: int = 500) -> Field:
    return train(labelled_pages(n))


def _extract_batches(field: Field):
    def run(batches):
        for batch in batches:
            texts = [field.extract(h.as_py()) for h in batch.column(2)]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extract_batches(field or trained_field()), "page_id bigint, url string, text string, n_chars bigint")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Per page: the main text and its length."""
    return extract(table(spark, sf_dir, "pages"))
