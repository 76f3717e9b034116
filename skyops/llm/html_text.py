"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events. Text between block-level tags makes a line,
with its number of tags and the elements it lies in; lines inside menus, headers, footers, sidebars,
notices, adverts, forms and reader comments (by element or role, or by a hint in class or id) have no
text of their own in the ratios. A hint is a name whose head is such a word (``sidebar``, ``site-footer``; not
``has-sidebar`` or ``market-share``), and the page decides: an element that holds the main element or an
article, or prose under the page's title, or all prose there is, is not aside. The ratios of text to tags are smoothed by a Gaussian over the lines, and lines
at or above one standard deviation are content. From the innermost element that holds most of that
text the region is widened to the article around it, else to the main element, else as far as no
line of those kinds and no list of links stands beside it; text that stands directly in an element
around that, up to the main element, is part of it. All its lines are taken but those of the kinds
above and lists of two or more links outside the prose, so that headings, leads, short paragraphs and
references of an article stay.

Cases: null and empty pages, and pages without content, give an empty text; broken markup is read
as far as it makes sense (an open paragraph ends at the next, unknown end tags are ignored, what is
open at the end is closed; a link without its end tag ends with its block or at the next link, an
open label such as a button at the next block, other open or self-closed elements without text of
the page hide nothing); character references are decoded; white space within a block is one
space; a very long page is streamed whole; equal rows give equal texts; added columns replace
columns of the same names and others stay.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyops.llm.batches import append

SIGMA, RADIUS = 1.0, 3
#: Share of the content's text that the region must hold.
MOST = 0.9
#: Share of a line's text in links from which it is a list of links.
LINKED = 0.8

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img",
           "wbr", "br"}
_SILENT = {"script", "style", "noscript", "template", "title", "svg", "math", "iframe", "object", "canvas", "audio",
           "video", "select", "button", "textarea", "datalist"}
#: Of these, which hold the next words also if they are left open, and which hold raw text to the end.
_LABELS, _RAW = {"button", "select", "textarea", "datalist", "title"}, {"script", "style"}
_ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "header"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
                "menu", "menubar"}
_ASIDE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
                "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "sidebars", "nav", "navbar",
                "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "share",
                "sharing", "social", "related", "recommended", "widget", "widgets", "comment", "comments", "commentlist",
                "respond", "reply", "replies", "disqus", "pagination", "pager", "search", "toolbar"}
#: Of these, which are clear also with a word before them that is not known.
_CLEAR = {"sidebar", "sidebars", "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "footer", "masthead",
          "cookie", "cookies", "gdpr", "advert", "adverts", "advertisement", "advertising", "newsletter", "comments", "commentlist",
          "disqus", "pagination", "popup", "modal", "toolbar"}
#: Words that say how or where something stands.
_LAYOUT = {"left", "right", "top", "bottom", "main", "site", "page", "global", "primary", "secondary", "container", "wrapper", "wrap",
           "box", "block", "area", "section", "list", "links", "link", "bar", "buttons", "button", "inner", "outer", "col", "column",
           "row", "item", "items", "group", "panel", "unit", "slot", "form", "post", "posts", "entry", "article", "articles", "content",
           "blog", "user", "reader", "mobile", "desktop", "sticky", "fixed", "small", "large", "js", "the", "of", "and", "us", "text"}
#: Words that say something is not there, or how it is shown.
_STATES = {"has", "have", "with", "without", "no", "not", "non", "hide", "hides", "hidden", "show", "shows", "open", "opened", "closed",
           "is", "enabled", "disabled"}
_HEADERS, _OF_ARTICLE = {"header", "masthead"}, {"entry", "post", "article", "story", "section", "content"}
#: Characters of a line of prose.
PROSE = 80
_ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
           "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "figure"}
_SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "td", "th", "blockquote", "aside",
          "nav", "header", "footer", "form", "figure"}
_CHILDLESS = {"svg", "math", "path", "iframe"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that a text stands in without being set apart from what is around them.
_PROSE = _HEADINGS | {"p", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "address"}
_TOKEN = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Events(HTMLParser):
    """The events of a page: what it is, name or text, attributes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, list]] = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.events.append(("empty", tag, attrs))

    def handle_endtag(self, tag):
        self.events.append(("end", tag, []))

    def handle_data(self, data):
        self.events.append(("data", data, []))


def ends_of(events: list[tuple[str, str, list]]) -> dict[int, int]:
    """Where the end tags of links and of silent elements are, if they come before that of an element around them."""
    out: dict[int, int] = {}
    around: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}
    link = None  # where it begins, elements around it
    for i, (kind, tag, _) in enumerate(events):
        if kind == "data":
            continue
        if tag == "a":
            if kind != "end":
                link = (i, len(around))
            else:
                if link and link[1] == len(around):
                    out[link[0]] = i
                link = None
        elif tag in _INLINE or tag in _VOID or (kind == "empty" and tag in _CHILDLESS):
            continue
        elif kind != "end":
            if tag in ("button", "select") and places.get(tag):  # these do not nest: the open one has no end
                at = places[tag].pop()
                around[at] = ("", around[at][1])
            places.setdefault(tag, []).append(len(around))
            around.append((tag, i))
        elif places.get(tag):
            at = places[tag][-1]
            if tag in _SILENT:
                out[around[at][1]] = i
            while len(around) > at:
                name, _ = around.pop()
                if name:
                    places[name].pop()
            if link and len(around) < link[1]:
                link = None
    return out


def hint(name: str, in_article: bool) -> int:
    """Whether a class or id hints that an element is aside: 0 no, 1 by its head, 2 by all of it."""
    tokens = _TOKEN.findall(_CAMEL.sub(" ", name).lower())
    found = _ASIDE_WORDS.intersection(tokens)
    if not found or _STATES.intersection(tokens):
        return 0
    if found <= _HEADERS and (in_article or _OF_ARTICLE.intersection(tokens)):
        return 0
    if all(t in _ASIDE_WORDS or t in _LAYOUT or t.isdigit() for t in tokens):
        return 2 if len(tokens) == 1 else 1
    head = [t for t in tokens if t not in _LAYOUT and not t.isdigit()][-1]
    return int(head in _CLEAR)


class Lines:
    """The lines of a page: text, tags, characters in links, elements around them, whether aside, links."""

    def __init__(self):
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool, int]] = []
        self.open: list[tuple[str, int, bool]] = []  # name, number, whether it is aside
        self.made = 0
        self.hints: dict[int, int] = {}  # elements that class or id say are aside
        self.mains: set[int] = set()  # elements around a main element or an article
        self.titles: set[int] = set()  # elements around a heading of the page
        self.names: dict[int, str] = {}
        self.label = False  # within a label that is left open
        self.linking = self.lasting = False  # within a link; whether it lasts to its end tag
        self.tags = self.linked = self.anchors = 0
        self.parts: list[str] = []

    def _flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, min(self.linked, len(text)), tuple(n for _, n, _ in self.open), self._aside(),
                               self.anchors))
            self.tags = 0
        self.parts, self.linked, self.anchors = [], 0, int(self.linking)

    def _aside(self) -> bool:
        return any(aside for _, _, aside in self.open)

    def _is_aside(self, name: str, attrs: list) -> bool:
        around = {n for n, _, _ in self.open}
        if name in _ASIDE:
            return not (name == "header" and around & {"article", "main"})
        if name in ("html", "body", "article", "main"):
            return False
        given = dict(attrs)
        if (given.get("role") or "").lower() in _ASIDE_ROLES:
            return True
        if name not in _HEADINGS and name != "p":
            names = f"{given.get('class') or ''} {given.get('id') or ''}".split()
            if found := max((hint(n, bool(around & {"article", "main"})) for n in names), default=0):
                self.hints[self.made] = found
        return False

    def _close(self, names: set[str]):
        """End the innermost of these elements, unless a scope stands between."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in names:
                del self.open[k:]
                return
            if self.open[k][0] in _SCOPE:
                return

    def _block(self):
        self._flush()
        if self.linking and not self.lasting:
            self.linking, self.anchors = False, 0

    def start(self, tag: str, attrs: list, ended: bool):
        """A start tag; ``ended``: its own end tag ends it, which is known of links."""
        if tag in _INLINE:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.linking, self.lasting = any(k == "href" for k, _ in attrs), ended
                self.anchors += self.linking
            return
        if self.label and (tag in _VOID or tag in ("option", "optgroup")):
            return
        self._block()
        self.label = False
        if tag in _ENDS_P:
            self._close({"p"})
        if tag in _ENDS_ITSELF:
            self._close(_ENDS_ITSELF[tag])
        if tag not in _VOID:
            self.made += 1
            self.names[self.made] = tag
            self.open.append((tag, self.made, self._is_aside(tag, attrs)))
            if tag in ("main", "article", "h1") and not self._aside():
                (self.titles if tag == "h1" else self.mains).update(n for _, n, _ in self.open)

    def end(self, tag: str):
        if tag in _INLINE:
            if tag == "a":
                self.linking = False
            return
        names = [n for n, _, _ in self.open]
        if self.label and tag not in names:
            self.label = tag not in _LABELS
            return
        self._block()
        self.label = False
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]

    def read(self, events: list[tuple[str, str, list]]):
        ends = ends_of(events)
        until = -1  # the end tag of a silent element
        for i, (kind, tag, attrs) in enumerate(events):
            if kind == "data":
                if i > until and not self.label:
                    self.parts.append(tag)
                    if self.linking:
                        self.linked += len(tag.strip())
                continue
            self.tags += 2 if kind == "empty" and tag in _CHILDLESS else 1
            if i <= until:
                continue
            if kind == "end":
                self.end(tag)
            elif tag in _SILENT:
                if i in ends:
                    until = ends[i]
                elif tag in _RAW and kind == "start":
                    until = len(events)
                elif tag in _LABELS and kind == "start":
                    self.label = True
            else:
                self.start(tag, attrs, i in ends)
                if kind == "empty" and tag in _CHILDLESS:
                    self.end(tag)
        self._flush()
        self._decide()

    def _decide(self):
        """Lines in elements that are aside by a hint which the page does not deny."""
        prose = [(set(line[3]), line) for line in self.lines if len(line[0]) >= PROSE and not line[4] and line[2] < LINKED * len(line[0])]
        aside = {n for n in self.hints if n not in self.mains}
        for n in sorted(aside):  # outer elements first
            if any(n in around for around, _ in prose):
                outside = any(n not in around and not around & aside for around, _ in prose)
                if n in self.titles or (self.hints[n] == 1 and not outside):
                    aside.discard(n)
        self.lines = [(*line[:4], line[4] or not aside.isdisjoint(line[3]), line[5]) for line in self.lines]


def lines_of(html: str) -> Lines:
    parser = Events()
    parser.feed(html)
    parser.close()
    page = Lines()
    page.read(parser.events)
    return page


def smoothed(values: np.ndarray) -> np.ndarray:
    """Means under a Gaussian over neighbouring lines; beyond the ends there is nothing."""
    k = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    return np.convolve(values, k / k.sum())[RADIUS : RADIUS + len(values)]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines have a smoothed ratio of one standard deviation or more."""
    smooth = smoothed(ratios)
    return (smooth >= smooth.std() - 1e-12) & (ratios > 0)


def link_lists(lines: list[tuple], linked: list[bool]) -> list[bool]:
    """Which lines stand in a run of link lines that has two links or more."""
    out, k = [False] * len(lines), 0
    while k < len(lines):
        end = k
        while end < len(lines) and linked[end]:
            end += 1
        if sum(line[5] for line in lines[k:end]) > 1:
            out[k:end] = [True] * (end - k)
        k = max(end, k + 1)
    return out


def article_lines(page: Lines, region: int, content: np.ndarray, linked: list[bool]) -> list[bool]:
    """Which lines belong to the article that holds the region."""
    lines = page.lines
    path = next(x[3] for x in lines if region in x[3])
    path = path[: path.index(region) + 1]
    kinds = [page.names[n] for n in path]
    last = {kind: k for k, kind in enumerate(kinds)}
    k = last.get("article", last.get("main", len(path) - 1))
    top = min(k, last.get("main", k if "article" in last else 0))
    shared = []  # how many of the elements of the path are around each line
    for line in lines:
        n = 0
        for a, b in zip(path, line[3], strict=False):
            if a != b:
                break
            n += 1
        shared.append(n)
    if "article" in last or "main" in last:  # the prose begins with the first text that is no link
        prose = [i for i, n in enumerate(shared) if n > k and not lines[i][4] and not linked[i]]
        first, end = min(prose), max(i for i, n in enumerate(shared) if n > k)
    else:
        prose = [i for i, n in enumerate(shared) if n > k and content[i]]
        first, end = min(prose), max(prose)
    bare = [ok and not first <= i <= end for i, ok in enumerate(link_lists(lines, linked))]
    k = max([top, *(n for n, line, off in zip(shared, lines, bare, strict=True) if (line[4] or off) and n <= k)])
    around = set(path[top:k])

    def holder(line):
        return next((n for n in reversed(line[3]) if page.names[n] not in _PROSE), None)

    return [not line[4] and not off and (n > k or holder(line) in around)
            for n, line, off in zip(shared, lines, bare, strict=True)]


def main_text(html: str | None) -> str:
    """The blocks of the main text, joined by line feeds."""
    page = lines_of(html or "")
    lines = page.lines
    linked = [n >= LINKED * len(text) for text, _, n, *_ in lines]
    own = [not line[4] and not ok for line, ok in zip(lines, linked, strict=True)]
    ratios = np.array([len(x[0]) / max(1, x[1]) if ok else 0.0 for x, ok in zip(lines, own, strict=True)])
    if not ratios.any():
        return ""
    content = content_lines(ratios)
    if not content.any():
        content = ratios > 0
    held: dict[int, int] = {}
    depth: dict[int, int] = {}
    total = 0
    for line, ok in zip(lines, content, strict=True):
        if ok:
            total += len(line[0])
            for k, n in enumerate(line[3]):
                held[n] = held.get(n, 0) + len(line[0])
                depth[n] = k
    region = max((n for n in held if held[n] >= MOST * total), key=lambda n: depth[n], default=None)
    while region is not None and len({line[3] for line in lines if region in line[3]}) == 1 and depth[region]:
        region = next(n for n in reversed(next(x[3] for x in lines if region in x[3])) if depth.get(n) == depth[region] - 1)
    if region is None:
        lists = link_lists(lines, linked)
        first, end = np.flatnonzero(content)[[0, -1]]
        taken = [not line[4] and not (ok and not first <= i <= end) for i, (line, ok) in enumerate(zip(lines, lists, strict=True))]
    else:
        taken = article_lines(page, region, content, linked)
    return "\n".join(line[0] for line, ok in zip(lines, taken, strict=True) if ok)


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of each page."""
    def make():
        return lambda batch: [pa.array([main_text(h) for h in batch.column(html).to_pylist()], pa.string())]

    return append(df, [T.StructField(text, T.StringType())], make)
