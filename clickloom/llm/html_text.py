"""Main text of HTML pages by the line-block distribution.

Markup is stripped into lines, one a block element, in page order. Elements
that never hold the article (menus, headers, footers, sidebars, forms, scripts
and those whose class, id or role names an advert, notice, sidebar, share bar or
reader comments) leave a gap of empty lines. A name counts as a whole: a listed
word, or a compound of such words with words for boxes and, outside an article,
for places on the page (``share-buttons``, ``site-header``, not ``menu-planning``);
inside an article no id of a heading or section does. Where that leaves nothing
of a page, it is read again without names.

Text lengths - links do not count - are summed over sliding windows of ``WINDOW``
lines over the whole page: text begins where the sum surges and ends where it
dives to nothing; every line between the two points is kept, and so is a page's
second text after a gap. Linked lines between two texts stay where they are
shorter than either. An ``article`` or ``main`` counts where it holds at least half
of the text: all of its lines then belong to one text, linked ones included.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.textops import map_batches, texts_of

#: lines of one window, and the text length (code points) that is a surge
WINDOW, SURGE = 3, 40

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title|head(?!er))(?=[\s/>])[^>]*+>(?:.*?</(?P=raw)\s*+[^>]*+>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>"
    r"|<[!?][^>]*+>", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)

#: elements outside the article
APART = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu"))
#: words of a class, id or role that mark such an element
APART_WORDS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie",
    "cookies", "consent", "notice", "notices", "alert", "popup", "modal", "newsletter", "subscribe", "sidebar", "side",
    "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "footer", "masthead", "toolbar",
    "share", "social", "related", "recommended", "comment", "comments", "replies", "disqus", "login", "signup", "search",
    "pagination", "pager", "copyright"))
#: words that such a word is compounded with in the name of a box
BOX_WORDS = frozenset((
    "area", "articles", "bar", "block", "box", "button", "buttons", "container", "form", "icons", "item", "link", "links", "list",
    "panel", "posts", "slot", "stories", "unit", "wrapper"))
#: words that say where on a page, or of what, such a box is
PLACE_WORDS = frozenset((
    "blog", "bottom", "fixed", "global", "inner", "left", "main", "mobile", "outer", "page", "primary", "right", "secondary", "site",
    "sticky", "top", "user"))
#: the same of an article, whose header is its own
TEXT_WORDS = frozenset(("article", "entry", "post", "story"))
#: elements whose id, inside an article, names what they are about
OWN_IDS = frozenset(("h2", "h3", "h4", "h5", "h6", "section"))
#: elements that begin and end a line
BLOCKS = frozenset((
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "legend", "li", "main", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", *APART))
#: elements without an end tag
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
_SPACED = frozenset(("br", "td", "th", "img", "option", "input"))


def _is_apart(tag: str, rest: str, inside: int, by_name: bool) -> bool:
    if tag in APART:
        # an article's own header holds its headline
        return not (tag == "header" and inside)
    if "=" not in rest or tag in ("html", "body", "article", "main", "h1"):
        return tag in ("article", "main") and "=" in rest and any(
            w in ("comment", "comments", "reply", "ad", "advert", "sponsored") for w in _words(rest))
    # the article's own headings and sections bear such words as topics
    return by_name and any(_names_apart(name, inside > 0) for name in _whole_names(rest, not inside or tag not in OWN_IDS))


def _words(rest: str) -> list[str]:
    return [w for m in _NAMES.finditer(rest) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower())]


def _names_apart(name: str, inside: bool) -> bool:
    """A listed word, or a compound of such words and words for boxes only; outside
    an article words for places and texts may be part of it too."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    listed = {p for p in parts if p in APART_WORDS}
    rest = [p for p in parts if p not in listed and p not in BOX_WORDS]
    if inside or not listed:
        return bool(listed) and not rest
    if any(p in TEXT_WORDS for p in rest) and listed <= {"header"}:
        return False
    return all(p in PLACE_WORDS or p in TEXT_WORDS for p in rest)


def _whole_names(rest: str, ids: bool) -> list[str]:
    """Whole class and role names, and the id where ``ids``, without their case."""
    return [name for m in _NAMES.finditer(rest) if ids or not m[0].lower().startswith("id")
            for name in (m[1] or m[2] or m[3] or "").lower().split()]


class _Lines:
    """Lines of a page: text, text length without links, inside an article?"""

    def __init__(self):
        self.text: list[str] = []
        self.length: list[int] = []
        self.inside: list[bool] = []
        self.part: list[str] = []
        self.linked = 0

    def add(self, raw: str, in_link: bool) -> None:
        if raw:
            self.part.append(raw)
            if in_link:
                self.linked += len(raw.strip())

    def end(self, inside: bool) -> None:
        if self.part:
            text = " ".join(html.unescape("".join(self.part)).split())
            if text:
                self.text.append(text)
                self.length.append(0 if 2 * self.linked > len(text) else len(text))
                self.inside.append(inside)
            self.part = []
        self.linked = 0

    def gap(self, inside: bool) -> None:
        self.end(inside)
        for _ in range(WINDOW):
            self.text.append("")
            self.length.append(0)
            self.inside.append(inside)


def lines_of(page: str, by_name: bool = True) -> _Lines:
    out = _Lines()
    at = inside = links = 0
    skip, depth, skip_from = "", 0, 0
    unclosed: set[int] = set()
    while True:
        m = _TOKEN.search(page, at)
        if not skip:
            out.add(page[at:m.start() if m else len(page)], links > 0)
        if not m:
            if not skip:
                break
            # the element apart never ends: take its start tag as if it were not there
            unclosed.add(skip_from)
            at, skip = skip_from, ""
            continue
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if skip:
            if tag == skip:
                depth += -1 if m["end"] else not m["rest"].endswith("/")
                if not depth:
                    skip = ""
            continue
        if tag in VOID:
            if tag == "hr":
                out.end(inside > 0)
            elif tag in _SPACED:
                out.add(" ", False)
            continue
        if m["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                out.end(inside > 0)
                links = 0
                if tag in ("article", "main"):
                    inside = max(0, inside - 1)
            elif tag in _SPACED:
                out.add(" ", False)
            continue
        if at not in unclosed and not m["rest"].endswith("/") and _is_apart(tag, m["rest"], inside, by_name):
            out.gap(inside > 0)
            skip, depth, skip_from = tag, 1, at
        elif tag == "a":
            links += 1
        elif tag in BLOCKS:
            out.end(inside > 0)
            links = 0
            inside += tag in ("article", "main")
        elif tag in _SPACED:
            out.add(" ", False)
    out.end(inside > 0)
    return out


def between(length: list[int], surge: int) -> Iterator[tuple[int, int]]:
    """(surge, dive) points: maximal runs of lines over which the window sums
    never dive to zero and reach ``surge`` somewhere, cut to lines with text."""
    n, i = len(length), 0
    while i < n:
        if not length[i]:
            i += 1
            continue
        last, j, best = i, i, 0
        while j < n and j - last < WINDOW:
            if length[j]:
                last, best = j, max(best, sum(length[j:j + WINDOW]))
            j += 1
        if best >= surge:
            yield i, last + 1
        i = j


def _joined(spans: list[tuple[int, int]], lines: _Lines) -> list[tuple[int, int]]:
    """Neighbouring texts as one where only linked lines, shorter than either, lie between."""
    size = lambda a, b: sum(lines.length[a:b])
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out:
            lo, hi = out[-1]
            between_ = lines.text[hi:a]
            if all(between_) and sum(map(len, between_)) < min(size(lo, hi), size(a, b)):
                out[-1] = lo, b
                continue
        out.append((a, b))
    return out


def _text_of(lines: _Lines) -> str:
    total, marked = sum(lines.length), sum(n for n, inside in zip(lines.length, lines.inside, strict=True) if inside)
    if marked and 2 * marked >= total:
        return "\n".join(t for t, inside in zip(lines.text, lines.inside, strict=True) if inside and t)
    spans = list(between(lines.length, SURGE)) or list(between(lines.length, 1))
    return "\n".join(t for a, b in _joined(spans, lines) for t in lines.text[a:b] if t)


def main_text(page: str | None) -> str:
    """The page's article, blocks joined by line feeds; empty if there is none."""
    return _text_of(lines_of(page or "")) or _text_of(lines_of(page or "", by_name=False))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, repeated ones too. A null or
    empty page has an empty text; url is passed on as it is (null stays null);
    other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h) for h in texts_of(b, "html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
