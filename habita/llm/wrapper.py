"""Main text of web pages by wrapper induction.

Pages of one host come from one template. The block elements of each page are
folded to a skeleton (siblings with the same label become one node) and aligned
with the host's template by simple tree matching; aligned nodes add up how often
a node occurs, which lines it holds and how much of that is link text. Lines that
stay the same are template, the others are slots. Partial templates are built
where pages are read, and merged per host by the same matching, so no task sees
a host's pages; all templates are sent to the pages if they are small, else
pages and templates meet in several parts per host. A page is then aligned with its host's template. Of marked
article elements those count whose template node has most of the varying running
text; without one the article is the smallest subtree with nearly all of it. Page
furniture and constant lines, inside the article too, are left out.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialize, release
from .reputation import url_parts

CONSTANT = 0.8          # share of a node's pages with the same line that makes the line template
ENOUGH = 5              # pages that a node must occur in before that counts
TEXTS = 16              # lines per node whose counts are kept, times its lines a page (frequent ones survive)
MAIN_SHARE = 0.8        # of the varying running text, that the article's subtree holds
TEASER = 0.5            # of the main article's running text, that another article must hold
DEEP = 48               # levels from which unnamed wrappers dissolve into the element around them
DEEPEST = 160           # levels from which elements become siblings instead of children, as browsers do (at 512)
SENT_BYTES = 32 << 20   # of templates that are sent to all executors; beyond, pages and templates meet by host
SALTS = 16              # parts of a host's pages where they meet
VARIES = 0.2            # of an article's running text, that must vary before its constant lines are taken as template

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img".split())
FURNITURE = set("head script style noscript template nav footer aside form button select textarea option iframe object svg canvas dialog menu audio video title meta link".split())
RAW = {"script", "style", "textarea", "title", "noscript"}
# words of class and id attributes that name page furniture (fixed values)
FURNITURE_WORDS = set("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu
breadcrumb breadcrumbs sidebar aside rail footer header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert
popup modal overlay newsletter subscribe subscription signup login form search share sharing social comment comments disqus replies reply
responses discussion related recommended recommendations widget widgets pagination pager tags toc skip legal copyright""".split())
# names of comments, adverts and forms: left out of an article whatever its template says
SURE_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored comment comments disqus signup login form".split())
# words that may stand beside these in a whole name
BOX_WORDS = set("""area article articles bar block body bottom box button buttons col container content entry google group icons inner item items label
left link links list main outer page panel post posts right row section site slot text thread top unit wrap wrapper""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
BARRIER = {"ul": {"li"}, "ol": {"li"}, "dl": {"dt", "dd"}, "table": {"tr", "td", "th"}, "select": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "words", "names", "slug", "children")

    def __init__(self, tag: str, words: tuple = (), names: tuple = (), slug: tuple = ()):
        self.tag, self.words, self.names, self.slug = tag, words, names, slug     # words and whole names; words of a section's id
        self.children = []                                                        # nodes and strings

    @property
    def label(self) -> str:
        return self.tag + "".join("." + w for w in self.words)


# wrappers without meaning of their own (fixed values)
PLAIN = set("div span b i u em strong font center small big tbody".split())


def parse(page: str) -> Node:
    """Element tree of a page; unknown, unclosed and stray tags are taken as browsers do in the common cases.

    The tree is at most ``DEEPEST`` levels deep, whatever the page: below
    ``DEEP`` an unnamed wrapper's content belongs to the element around it, and
    at ``DEEPEST`` an element becomes the next sibling of the one it stands in.
    No text is lost, and the order stays.
    """
    root = Node("#root")
    stack, at, size = [root], 0, len(page)
    depth = [0]                     # of each open element's node in the tree
    opened: dict[str, int] = {}     # open elements per tag

    def close(k: int) -> None:
        for n in stack[k:]:
            opened[n.tag] -= 1
        del stack[k:], depth[k:]
    while at < size:
        m = _TOKEN.match(page, at)
        if m is None:               # an unfinished tag: text from here on
            stack[-1].children.append(page[at:])
            break
        at = m.end()
        text = m.group(4)
        if text is not None:
            stack[-1].children.append(text)
            continue
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if opened.get(tag):
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        words: list[str] = []
        names: list[str] = []
        slug: list[str] = []
        raw = m.group(3)
        if raw and not raw.isspace():
            for a in _ATTRIBUTE.finditer(raw):
                key, value = a.group(1).lower(), (a.group(2) or a.group(3) or a.group(4) or "").lower()
                if key == "hidden" or (key == "aria-hidden" and value == "true"):
                    words.append("hidden")
                    names.append("hidden")
                elif key == "itemprop":
                    words += ["articlebody"] if value == "articlebody" else []
                elif key == "id" and tag in HEADINGS:       # the heading's own text
                    continue
                elif key == "id" and tag == "section":
                    slug += _WORD.findall(value)
                elif key != "aria-hidden":
                    words += _WORD.findall(value)
                    names += value.split()
        closes = CLOSES.get(tag, set())
        if tag in ENDS_P:
            closes = closes | {"p"}
        if any(map(opened.get, closes)):
            for k in range(len(stack) - 1, 0, -1):
                here = stack[k].tag
                if here in closes:
                    close(k)
                    break
                if here in BARRIER and closes & BARRIER[here] or here not in INLINE and here not in closes and here not in {"p", "td", "th", "tr", "tbody"}:
                    break
        node = Node(tag, tuple(dict.fromkeys(words)), tuple(names), tuple(slug))
        level = depth[-1] + 1
        if level > DEEP and tag in PLAIN and not words and not raw.rstrip().endswith("/"):
            node.children, level = stack[-1].children, depth[-1]
        else:
            if level > DEEPEST:
                stack[bisect_left(depth, DEEPEST) - 1].children.append(node)       # depths do not fall along the stack
                level = DEEPEST
            else:
                stack[-1].children.append(node)
        if tag in RAW and not raw.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is None:
                at = size
            else:
                node.children.append(page[at:end.start()])
                at = end.end()
        elif tag not in VOID and not raw.rstrip().endswith("/"):
            stack.append(node)
            depth.append(level)
            opened[tag] = opened.get(tag, 0) + 1
    return root


def is_furniture(node: Node, inside_article: bool) -> bool:
    """Left out whatever the template says."""
    if node.tag in FURNITURE:
        return True
    if inside_article:
        return "hidden" in node.names or node.tag != "h1" and _named(node, SURE_WORDS) or bool({"complementary", "contentinfo"} & set(node.names))
    if "hidden" in node.words or node.tag == "header":
        return True
    if node.tag in ("article", "main", "body", "html", "h1") and not {"comment", "comments", "related", "ad", "ads"} & set(node.words):
        return False
    return bool(FURNITURE_WORDS & {*node.words, *node.slug}) or "complementary" in node.words or "contentinfo" in node.words


def may_be_furniture(node: Node) -> bool:
    """Named so inside an article; the template has to confirm it."""
    return node.tag != "h1" and _named(node, FURNITURE_WORDS)


def _named(node: Node, which: set) -> bool:
    """A whole name is made of furniture words, one of ``which`` among them, and words for boxes; an article may have a header."""
    for name in node.names:
        words = set(_WORD.findall(name)) - {"header"}
        if words & which and words <= FURNITURE_WORDS | BOX_WORDS:
            return True
    return False


def is_article(node: Node) -> bool:
    return node.tag == "article" or "articlebody" in node.words


def is_main(node: Node) -> bool:
    return node.tag == "main" or "main" in node.words and node.tag == "div"


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


class Line:
    """Text between two block borders: all of it, characters in links, and its pieces where some are of named inline elements."""
    __slots__ = ("text", "linked", "pieces")

    def __init__(self, pieces: list):
        self.text = _clean("".join(t for t, _, _ in pieces))
        self.linked = min(sum(len(_clean(t)) for t, linked, _ in pieces if linked), len(self.text))
        self.pieces = list(pieces) if any(p[2] for p in pieces) else None

    @property
    def key(self) -> str:
        """Hash, and characters outside links."""
        return hashlib.blake2b(self.text.encode("utf-8", "replace"), digest_size=6).hexdigest() + f"{len(self.text) - self.linked:x}"

    def shown(self, drop) -> str:
        """Without the inline elements that ``drop`` says are furniture."""
        return self.text if self.pieces is None else _clean("".join(t for t, _, names in self.pieces if not any(map(drop, names))))


class Block:
    """Block element; inline elements are dissolved into its lines, named ones kept aside as well for the template."""
    __slots__ = ("node", "inside", "furniture", "items", "inline")

    def __init__(self, node: Node, marked, inside: bool = False, linked: bool = False, inline: bool = False):
        self.node, self.items, self.inline = node, [], [] if not inline else None      # items: lines and blocks
        self.furniture = is_furniture(node, inside) or inline
        self.inside = inside = inside or marked is not None and marked(node)
        pieces: list[tuple[str, bool, tuple]] = []

        def end():
            if any(not t.isspace() for t, _, _ in pieces):
                line = Line(pieces)
                if line.text:
                    self.items.append(line)
            pieces.clear()

        def add(n, linked, names):
            if n.tag == "br":
                pieces.append((" ", linked, names))
            for c in n.children:
                if isinstance(c, str):
                    pieces.append((c, linked, names))
                elif c.tag in INLINE:
                    into = names
                    if c.names and not inline and (is_furniture(c, inside) or may_be_furniture(c)):
                        self.inline.append(Block(c, marked, inside, linked or c.tag == "a", True))
                        into = (*names, self.inline[-1])
                    add(c, linked or c.tag == "a", into)
                else:
                    end()
                    if c.tag not in FURNITURE:
                        self.items.append(Block(c, marked, inside, linked))
        add(node, linked, ())
        end()

    @property
    def blocks(self) -> list[Block]:
        return [x for x in self.items if isinstance(x, Block)]

    @property
    def lines(self) -> list[Line]:
        return [x for x in self.items if isinstance(x, Line)]


def layout(root: Node) -> tuple[Block, object]:
    """Blocks of a page's tree, and the test that marks its articles (None without any)."""
    marked = is_article if _holds(root, is_article) else is_main if _holds(root, is_main) else None
    return Block(root, marked), marked


class Fold:
    """Skeleton node: all siblings of one label, their blocks folded again."""
    __slots__ = ("label", "members", "children")

    def __init__(self, label: str, members: list[Block | Node]):
        members = [layout(m)[0] if isinstance(m, Node) else m for m in members]
        self.label, self.members = label, members
        groups: dict[str, list[Block]] = {}
        for m in members:
            for c in m.blocks + (m.inline or []):
                groups.setdefault(c.node.label, []).append(c)
        self.children = [Fold(k, v) for k, v in groups.items()]


def new_template(fold: Fold) -> dict:
    """Template of one page: label, pages, members, lines (key -> pages), their number and what their counts lack,
    characters, of them in links, article, furniture, children."""
    lines = [x for m in fold.members for x in m.lines]
    texts = dict.fromkeys((x.key for x in lines), 1)
    return {"l": fold.label, "n": 1, "m": len(fold.members), "t": texts, "s": len(texts), "e": 0, "c": sum(len(x.text) for x in lines), "k": sum(x.linked for x in lines),
            "a": int(is_article(fold.members[0].node)), "f": int(fold.members[0].furniture), "x": [new_template(c) for c in fold.children]}


def match(a: list, b: list, label_a, label_b, children_a, children_b) -> tuple[int, list]:
    """Simple tree matching of two child lists: size of the best alignment in order, and its pairs."""
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    weight = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best = max(rows[i][j + 1], rows[i + 1][j])
            if label_a(x) == label_b(y):
                w = 1 + match(children_a(x), children_b(y), label_a, label_b, children_a, children_b)[0]
                weight[i, j] = w
                best = max(best, rows[i][j] + w)
            rows[i + 1][j + 1] = best
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return rows[len(a)][len(b)], pairs[::-1]


def _same_label(x):
    return x["l"]


def _kids(x):
    return x["x"]


def merge(into: dict, other: dict) -> dict:
    """Add another template of the same host; nodes without a partner are put in at their place."""
    for k in ("n", "m", "s", "e", "c", "k"):
        into[k] += other[k]
    counts = into["t"]
    for k, v in other["t"].items():
        counts[k] = counts.get(k, 0) + v
    room = TEXTS * -(-into["s"] // into["n"])
    if len(counts) > room:          # frequent lines survive: every count gives up what the next one has
        cut = sorted(counts.values(), reverse=True)[room]
        into["t"] = {k: v - cut for k, v in counts.items() if v > cut}
        into["e"] += cut
    _, pairs = match(into["x"], other["x"], _same_label, _same_label, _kids, _kids)
    partner = {j: into["x"][i] for i, j in pairs}
    at = 0
    for j, child in enumerate(other["x"]):
        if j in partner:
            merge(partner[j], child)
            at = next(i for i, x in enumerate(into["x"]) if x is partner[j]) + 1
        else:
            into["x"].insert(at, child)
            at += 1
    return into


def _local_templates(batches):
    """One template per host and task; handed on early when there are many hosts."""
    task = TaskContext.get().partitionId()
    held: dict[str, dict] = {}

    def flush():
        return pd.DataFrame({"host": list(held), "task": task, "template": [json.dumps(t) for t in held.values()]})
    for pdf in batches:
        for host, page in zip(pdf["host"], pdf["html"]):
            own = new_template(Fold("#root", [parse(page)]))
            held[host] = merge(held[host], own) if host in held else own
        if len(held) > 2000:
            yield flush()
            held = {}
    if held:
        yield flush()


def _merged(pdf: pd.DataFrame) -> dict:
    first, *rest = map(json.loads, sorted(pdf["template"]))
    for t in rest:
        merge(first, t)
    return first


def _merge_templates(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "template": [json.dumps(_merged(pdf))]})


def _finished_templates(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "template": [json.dumps(_finish(_merged(pdf)))]})


def _finish(t: dict) -> dict:
    """Only constant lines are needed from here on."""
    t["t"] = {k: t["t"][k] for k in _constants(t)}
    for c in t["x"]:
        _finish(c)
    return t


def _constants(t: dict) -> list[str]:
    """Lines that nearly all pages with the node have; a count lacks at most ``e``."""
    return [k for k, v in t["t"].items() if v + t["e"] >= CONSTANT * t["n"] and 2 * v >= t["n"]] if t["n"] >= ENOUGH else []


def _chars(t: dict) -> int:
    """Characters outside links and furniture, in a template's subtree."""
    return 0 if t["f"] else max(t["c"] - t["k"], 0) + sum(map(_chars, t["x"]))


def _named_text(t: dict) -> tuple[int, int, int]:
    """Characters of a named element's subtree, of them in links, and outside links in lines that vary."""
    constant = sum((t["t"][k] + t["e"]) * int(k[12:], 16) for k in _constants(t))
    parts = [(t["c"], t["k"], max(t["c"] - t["k"] - constant, 0)), *(_named_text(c) for c in t["x"])]
    return tuple(map(sum, zip(*parts)))


def _running(t: dict, articles: bool = True) -> int:
    """Of these the characters of lines that vary; on demand without article elements."""
    if t["f"] or t["a"] and not articles:
        return 0
    constant = sum((t["t"][k] + t["e"]) * int(k[12:], 16) for k in _constants(t))
    return max(t["c"] - t["k"] - constant, 0) + sum(_running(c, articles) for c in t["x"])


def main_subtree(template: dict, articles: bool = True) -> list[dict]:
    """Path to the smallest subtree with nearly all varying running text."""
    path, total = [template], _running(template, articles)
    while total:
        nxt = next((c for c in path[-1]["x"] if _running(c, articles) >= MAIN_SHARE * total and c["l"].split(".")[0] not in {"p", "h1", "h2", "h3"}), None)
        if nxt is None:
            break
        path.append(nxt)
    return path


class Page:
    """A page's blocks aligned with its host's template."""

    def __init__(self, page: str, template: dict | None):
        self.root, self.marked = layout(parse(page))
        self.template = template
        self.known: dict[int, dict] = {}        # block -> template node
        if template is not None:
            self.known[id(self.root)] = template
            self._align(Fold("#root", [self.root]).children, template["x"])

    def _align(self, folds, nodes):
        _, pairs = match(folds, nodes, lambda f: f.label, _same_label, lambda f: f.children, _kids)
        for i, j in pairs:
            for m in folds[i].members:
                self.known[id(m)] = nodes[j]
            self._align(folds[i].children, nodes[j]["x"])

    def constants(self, block: Block) -> set[str]:
        t = self.known.get(id(block))
        return set(_constants(t)) if t is not None else set()

    def confirmed(self, block: Block, trusted: bool) -> bool:
        """Constant or link-heavy in the host's template; without one, link-heavy on the page."""
        t = self.known.get(id(block))
        if t is None or t["n"] < ENOUGH:
            t = new_template(Fold("", [block]))
        every, linked, varying = _named_text(t)
        return 2 * linked >= every or trusted and varying <= (1 - CONSTANT) * every

    def own(self, block: Block) -> int:
        """Characters of varying running text on the page itself."""
        fixed = self.constants(block)
        return sum(len(x.text) - x.linked for x in block.lines if not fixed or x.key not in fixed) + sum(self.own(c) for c in block.blocks if not c.furniture)

    def articles(self, block: Block) -> list[Block]:
        """Outermost marked elements."""
        out = []
        for c in block.blocks:
            if not c.furniture:
                out += [c] if self.marked(c.node) else self.articles(c)
        return out

    def main(self) -> list[Block]:
        """Blocks that hold the main text; none: the whole page but furniture."""
        found = self.articles(self.root) if self.marked is not None else []
        if len(found) > 1:
            nodes = [self.known.get(id(b)) for b in found]
            if all(t is not None and t["n"] >= ENOUGH for t in nodes):
                score = [_running(t) / t["m"] for t in nodes]
                best = max(score)
                found = [b for b, x in zip(found, score) if x >= TEASER * best]
                outside = _running(self.template, False) / self.template["n"]
                if outside > best / TEASER and all(map(points_elsewhere, found)):
                    return self._subtree(False) or found
            size = [self.own(b) for b in found]
            found = [b for b, x in zip(found, size) if x >= TEASER * max(size) or not points_elsewhere(b)]
        if found or self.template is None:
            return found
        return self._subtree()

    def _subtree(self, articles: bool = True) -> list[Block]:
        node, out = main_subtree(self.template, articles)[-1], []

        def look(block):
            for c in block.blocks:
                if self.known.get(id(c)) is node:
                    out.append(c)
                else:
                    look(c)
        if node is not self.template:
            look(self.root)
        return out


def points_elsewhere(block: Block) -> bool:
    """A line that is all link: a teaser's heading, or 'read more'."""
    return any(x.linked >= len(x.text) for x in block.lines) or any(map(points_elsewhere, block.blocks))


def extract(page: str, template: dict | None) -> str:
    """Main text of a page, one line per block."""
    at = Page(page, template)
    main = at.main()
    chosen = set(map(id, main))
    nodes = {id(t): t for t in (at.known.get(id(b)) for b in main) if t is not None}.values()
    trusted = not main or sum(map(_running, nodes)) >= VARIES * sum(map(_chars, nodes))     # else copies of one page
    out: list[str] = []
    judged: dict[int, bool] = {}

    def drop(block, inside, trusted):
        """Furniture: inside the main text by whole names and the template, elsewhere by any word of a name."""
        if id(block) not in judged:
            if not inside:
                judged[id(block)] = block.furniture if block.inline is not None else is_furniture(block.node, block.inside)
            else:
                judged[id(block)] = is_furniture(block.node, True) or (may_be_furniture(block.node) or block.node.tag == "header" and block.furniture) and at.confirmed(block, trusted)
        return judged[id(block)]

    def walk(block, inside, size, skip, article):
        """``size``: running text of the main block around, 0 outside one; ``article``: that block is no page frame."""
        if id(block) in chosen:
            inside, size, article = True, at.own(block), block.node.tag not in ("body", "html")
        fixed = at.constants(block) if skip and inside else ()
        for x in block.items:
            if isinstance(x, Line):
                if inside and not (fixed and x.key in fixed):
                    shown = x.shown(lambda b: drop(b, article, skip))
                    if shown:
                        out.append(shown)
            elif not (drop(x, article, skip) or size and x.node.tag == "article" and id(x) not in chosen and points_elsewhere(x) and at.own(x) < TEASER * size):
                walk(x, inside, size, skip, article)
    walk(at.root, not main, 0, trusted, False)
    if not out and main:            # nothing of it varies
        judged.clear()
        walk(at.root, False, 0, False, False)
    return "\n".join(out)


def _holds(node: Node, test) -> bool:
    return any(not isinstance(c, str) and not is_furniture(c, False) and (test(c) or _holds(c, test)) for c in node.children)


@lru_cache(maxsize=256)
def _template(raw: str) -> dict:
    return json.loads(raw)


def _extracted(pdf: pd.DataFrame, raws) -> pd.DataFrame:
    out = [extract(page, _template(raw) if raw else None) for page, raw in zip(pdf["html"], raws)]
    return pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": out, "n_chars": [len(t) for t in out]})


def _extract_sent(sent):
    """Templates of all hosts as one broadcast value."""
    def run(batches):
        for pdf in batches:
            yield _extracted(pdf, [sent.value.get(h) for h in pdf["host"]])
    return run


def _extract_joined(batches):
    for pdf in batches:
        yield _extracted(pdf, pdf["template"])


def templates(pages: DataFrame) -> DataFrame:
    """One induced template per host: host, template (JSON)."""
    host, _ = url_parts(F.col("url"))
    local = pages.select(host.alias("host"), F.coalesce("html", F.lit("")).alias("html")).mapInPandas(_local_templates, "host string, task int, template string")
    # two levels, so that a host with pages in very many tasks has no large group
    return (local.groupBy("host", (F.col("task") % 64).alias("part")).applyInPandas(_merge_templates, "host string, template string")
            .groupBy("host").applyInPandas(_finished_templates, "host string, template string"))


RESULT = "page_id long, url string, text string, n_chars long"


def main_texts(pages: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page.

    Null html is empty and gives an empty text, as does a page without an
    article. Pages with a null url form the host ''. A host's only page has no
    template to lean on: marked furniture is left out. Where under a fifth of a
    host's article text varies, its pages are taken as copies of one article and
    nothing in it as template. Repeated rows each get a
    row; extra columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    host, _ = url_parts(F.col("url"))
    known = materialize(templates(pages), "templates")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    size = known.agg(F.sum(F.octet_length("template") + F.octet_length("host"))).first()[0] or 0
    if size <= sent_bytes:          # pages stay where they are
        sent = spark.sparkContext.broadcast({r["host"]: r["template"] for r in known.collect()})
        return own.mapInPandas(release(_extract_sent(sent)), RESULT)
    # a host's pages are dealt over several parts, its template goes to each of them
    salted = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    copies = known.select("host", "template", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return salted.join(copies, ["host", "salt"], "left").select("page_id", "url", "html", "template").mapInPandas(release(_extract_joined), RESULT)
