"""Element trees of page fragments, for the rules that need an element's exact extent.

A regular expression cannot tell where an element ends that holds others of its
kind, which sibling follows, or which parent an index counts in. Pages are
therefore parsed where they are read (Arrow batches, see ``select_rows``); a
rule returns raw texts and attribute values, and all further work on them stays
in Spark expressions. Texts and attribute values are decoded once, by the
standard library's table of character references.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from operator import attrgetter

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Elements without content, elements whose content is text, and
# which open elements a new one ends.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TEXT_ONLY = {"script", "style"}
ENDS = {"li": ({"li"}, {"ul", "ol"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
ENDS_PARAGRAPH = {"article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
                  "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}

# possessive, so that a run of characters is taken at once and never given back
_TOKEN = re.compile(r"(?P<text>[^<]+)|<!--.*?(?:-->|$)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<", re.S)
_TEXT_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in TEXT_ONLY}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)


class Page:
    """Elements and text nodes of one page in document order.

    A subtree is a stretch of both lists, so nothing here recurses and a page
    may be nested as deeply as it likes; the elements of one tag are found by
    bisection, not by a walk.
    """
    __slots__ = ("elements", "texts", "by_tag")

    def __init__(self):
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self.by_tag: dict[str, tuple[list[int], list[Element]]] = {}


class Element:
    """``index`` to ``last``: its subtree among the page's elements; ``text0`` to ``text1``: among its text nodes."""
    __slots__ = ("tag", "raw", "kids", "parent", "page", "index", "last", "text0", "text1", "_attrs")

    def __init__(self, tag: str, raw: str, parent: "Element | None", page: Page):
        self.tag, self.raw, self.kids, self.parent, self.page, self._attrs = tag, raw, [], parent, page, None
        self.index = index = len(page.elements)
        self.text0 = len(page.texts)
        self.last = self.text1 = None
        page.elements.append(self)
        known = page.by_tag.get(tag)
        if known is None:
            known = page.by_tag[tag] = ([], [])
        known[0].append(index)
        known[1].append(self)

    def close(self) -> None:
        self.last, self.text1 = len(self.page.elements), len(self.page.texts)

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            for name, double, single, bare in _ATTRIBUTE.findall(self.raw):
                value = double or single or bare
                self._attrs.setdefault(name.lower(), _html.unescape(value) if "&" in value else value)
        return self._attrs

    def add_text(self, text: str) -> None:
        if self.kids and isinstance(self.kids[-1], str):        # then it is the page's last text node too
            self.kids[-1] += text
            self.page.texts[-1] = self.kids[-1]
        elif text:
            self.kids.append(text)
            self.page.texts.append(text)

    def walk(self) -> list["Element"]:
        """Elements below this one in document order."""
        return self.page.elements[self.index + 1:self.last]

    def find(self, tag: str, test: Callable[["Element"], bool] | None = None) -> Iterator["Element"]:
        at, same = self.page.by_tag.get(tag, ((), ()))
        for k in range(bisect_right(at, self.index), bisect_left(at, self.last)):
            if test is None or test(same[k]):
                yield same[k]

    def children(self, tag: str, test: Callable[["Element"], bool] | None = None) -> list["Element"]:
        return [k for k in self.kids if not isinstance(k, str) and k.tag == tag and (test is None or test(k))]

    def parents_of(self, tag: str) -> list["Element"]:
        """This element and those below it that have a child of the tag, in document order."""
        return sorted({e.parent.index: e.parent for e in self.find(tag)}.values(), key=_place)

    @property
    def first_text(self) -> str | None:
        """First own text node."""
        for k in self.kids:
            if isinstance(k, str):
                return k
        return None

    def texts(self) -> list[str]:
        """Own text nodes."""
        return [k for k in self.kids if isinstance(k, str)]

    def all_texts(self) -> list[str]:
        """Text nodes of the whole subtree in document order."""
        return self.page.texts[self.text0:self.text1]


_place = attrgetter("index")


def has_class(part: str):
    """The class attribute contains ``part`` (as a substring)."""
    return lambda e: (part in e.raw or "&" in e.raw) and part in e.attrs.get("class", "")


def attr_is(name: str, value: str):
    return lambda e: (value in e.raw or "&" in e.raw) and e.attrs.get(name) == value


def first(values) -> str | None:
    return next(iter(values), None)


def texts_within(root: Element, test: Callable[[Element], bool]) -> list[str]:
    """Text nodes inside any ``div`` that passes, each once, in document order."""
    out: list[str] = []
    done = 0
    for d in root.find("div", test):
        if d.text1 > done:                  # else inside one that was taken
            out += root.page.texts[d.text0:d.text1]
            done = d.text1
    return out


PARAGRAPH = ({"p"}, {"td", "th", "li", "div", "section", "article"})
# What each tag ends: (tags that end, tags behind which they stay open).
CLOSES = {tag: ([ENDS[tag]] if tag in ENDS else []) + ([PARAGRAPH] if tag in ENDS_PARAGRAPH else []) for tag in {*ENDS, *ENDS_PARAGRAPH}}


def parse(page: str | None) -> Element:
    """The root of a page's elements; takes time and memory in proportion to the page, however deep it is."""
    page = page or ""
    doc = Page()
    root = top = Element("#root", "", None, doc)
    stack: list[Element] = []                       # open elements below the root
    places: dict[str, list[int]] = {}               # for each tag where its open ones stand, counted from 1: the nearest of a kind is known at once
    elements, texts, at = doc.elements, doc.texts, 0

    def nearest(tags) -> int:
        """Place of the innermost open element of these tags; 0 (the root's) if there is none."""
        return max((p[-1] for t in tags if (p := places.get(t))), default=0)

    def close(place: int) -> Element:
        """Close the element at a place and all inside it; the innermost one that is still open."""
        n, m = len(elements), len(texts)
        while len(stack) >= place:
            e = stack.pop()
            e.last, e.text1 = n, m
            places[e.tag].pop()
        return stack[-1] if stack else root

    while at < len(page):
        for token in _TOKEN.finditer(page, at):     # every place begins a token, so none is passed over
            text, end, tag, rest = token.groups()
            if tag is None:
                if text is not None:
                    top.add_text(_html.unescape(text) if "&" in text else text)
                elif token[0] == "<":
                    top.add_text("<")
                continue
            tag = tag.lower()
            if end:
                if places.get(tag):
                    top = close(places[tag][-1])
                continue
            for ended, fence in CLOSES.get(tag, ()):
                place = nearest(ended)
                if place and place >= nearest(fence):
                    top = close(place)
            e = Element(tag, rest, top, doc)
            top.kids.append(e)
            if tag in TEXT_ONLY:
                at = token.end()
                ends = _TEXT_END[tag].search(page, at)
                e.add_text(page[at:ends.start()] if ends else page[at:])
                at = ends.end() if ends else len(page)
                e.close()
                break
            if tag in VOID:
                e.close()
            else:
                stack.append(e)
                known = places.get(tag)
                if known is None:
                    known = places[tag] = []
                known.append(len(stack))
                top = e
        else:
            break
    close(1)
    root.close()
    return root


def release(root: Element) -> None:
    """Take a page that is done with apart: its elements hold each other, and would else lie there until a collection of cycles."""
    for e in root.page.elements:
        e.kids = e.parent = e.page = None


PAGES_AT_ONCE = 256         # that rows are gathered from
ROWS_AT_ONCE = 2048         # as Python tuples


def select_rows(pages: DataFrame, rule, fields: str, keep=("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Rows that ``rule(root, url)`` returns (tuples in the order of ``fields``) for each page, after ``keep``.

    Pages are parsed batch by batch where they are read: nothing is shuffled. Rows are
    handed on every ``ROWS_AT_ONCE``, so a worker holds one batch of
    pages and few rows, however many rows its pages give.
    """
    kept = pages.select(*keep, F.col(html_col).alias("__html"), *([] if "url" in keep else ["url"]))
    added = T._parse_datatype_string(fields)
    types = T.StructType([kept.schema[c] for c in keep] + added.fields)

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), PAGES_AT_ONCE):
                part = pdf.iloc[at:at + PAGES_AT_ONCE]
                took, rows = [], []
                for i, (url, text) in enumerate(zip(part["url"], part["__html"])):
                    root = parse(text)
                    for r in rule(root, url):
                        took.append(i)
                        rows.append(r)
                        if len(rows) == ROWS_AT_ONCE:
                            yield made(part, took, rows)
                            took, rows = [], []
                    release(root)
                if rows:
                    yield made(part, took, rows)

    def made(part, took, rows):
        return pd.concat([part[list(keep)].iloc[took].reset_index(drop=True), pd.DataFrame(rows, columns=added.names)], axis=1)
    return kept.mapInPandas(run, types)
