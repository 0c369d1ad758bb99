"""E1-E22 expressions checked against golden values and Python brute force."""

import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from habita.functions import normalise as N
from habita.functions import dom
from habita.functions.html import host_allowed, join_stripped, resolve_url
from habita.functions.text import (first_integer, price_digits, price_digits_dotted, py_strip,
                                   rooms_from_text, split_location, surface_from_text, wc_from_text)

NBSP, NNBSP = " ", " "


def col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_price_digits_golden(spark):
    cases = [("15 000 000 F CFA", "15000000", "15000000"),
             (f"15{NBSP}000{NNBSP}000 CFA", "15000000", f"15{NBSP}000{NNBSP}000"),
             ("Prix : 15 000", "", "0"),
             ("\n 1.500.000 FCFA", "1", "\n1500000"),
             ("CFA", "0", "0")]
    assert col(spark, [c[0] for c in cases], price_digits) == [c[1] for c in cases]
    assert col(spark, [c[0] for c in cases], price_digits_dotted) == [c[2] for c in cases]


def test_price_digits_matches_python(spark):
    texts = ["12 500 F", f" {NBSP}3", "a1b2", "", "\t\t", "9.9.9 x", f"1{NNBSP}2{NBSP}3 CFA"]

    def ref(t):
        runs = re.findall(r"[\d\s]+", t)
        return re.sub(r"\s", "", runs[0]) if runs else "0"
    assert col(spark, texts, price_digits) == [ref(t) for t in texts]


def test_py_strip_matches_python(spark):
    texts = [f"{NBSP} a  ", "\x1c b \x1f", "　c ", " d ", "e"]
    assert col(spark, texts, py_strip) == [t.strip() for t in texts]


def test_resolve_url_matches_urljoin(spark):
    base = ["https://a.example/x/y/page.html?q=1#f", "https://a.example", "http://h.example/dir/"]
    hrefs = ["/abs", "rel/p", "//cdn.example/i.png", "?page=2", "#top", "", "https://o.example/z",
             "mailto:x@y", "p.html", "../up", "../../../../x", "./here", "a/./b/../c", "..", ".",
             "d//e", "/x//y/", "/a/b/..", "rel?q=1#f", "../?q", "é/ü"]
    pairs = [(b, h) for b in base for h in hrefs]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = [r[0] for r in df.select(resolve_url(F.col("b"), F.col("h"))).collect()]
    assert got == [urljoin(b, h) for b, h in pairs]
    def is_plain(h):   # no '.'/'..' path segment and no empty segment in the path
        path = re.split(r"[?#]", h, maxsplit=1)[0]
        return h.startswith("//") or not (re.search(r"(^|/)\.\.?(/|$)", path) or "//" in path)
    plain = [(b, h) for b, h in pairs if is_plain(h)]
    fast = [r[0] for r in spark.createDataFrame(plain, "b string, h string")
            .select(resolve_url(F.col("b"), F.col("h"))).collect()]
    assert fast == [urljoin(b, h) for b, h in plain]


def test_tree_of_odd_markup():
    root = dom.parse("<p a=1 B='x &amp; y' c>one &eacute;&#8217;<b>two<p>three<ul><li>f<li>g<ul><li>h</ul></ul><!-- <i>no</i> --><script>if (a<b) '</p>'</script><img src=/i?a=1&amp;b=2>")
    p, q = root.find("p")
    assert p.attrs == {"a": "1", "b": "x & y", "c": ""} and p.all_texts() == ["one é’", "two"] and q.texts() == ["three"]
    ul = next(root.find("ul"))
    assert [li.texts() for li in ul.children("li")] == [["f"], ["g"]] and len(list(root.find("li"))) == 3
    assert not list(root.find("i")) and next(root.find("img")).attrs["src"] == "/i?a=1&b=2"
    assert dom.parse(None).kids == [] and dom.parse("a < b <c").all_texts() == ["a < b <c"]


def test_elements_end_at_their_own_tag():
    h = ('<div class="wrap"><div class="loc"><div class="x">A</div> B <a rel="tag">Q</a>'
         '<div><div>deep</div></div> C</div><div class="loc">second</div></div>')
    loc = next(dom.parse(h).find("div", dom.has_class("loc")))
    assert loc.all_texts() == ["A", " B ", "Q", "deep", " C"] and loc.texts() == [" B ", " C"]
    assert dom.texts_within(dom.parse(h), dom.has_class("loc")) == ["A", " B ", "Q", "deep", " C", "second"]


def test_deep_and_unclosed_pages(spark):
    """100,000 nested elements and 10,000 unclosed ones: read whole, in time linear in the page."""
    deep = "<div class=wrap>" * 100_000 + '<h1>deep</h1><p>text<a href="/x">link</a>' + "</div>" * 40_000 + "tail"
    unclosed = "<p>a" * 10_000 + "<span>b" * 10_000 + "<li><a href=y>c" * 10_000 + "</table>" * 10_000
    root = dom.parse(deep)
    assert len(root.walk()) == 100_003 and root.all_texts() == ["deep", "text", "link", "tail"]
    assert dom.texts_within(root, dom.has_class("wrap")) == ["deep", "text", "link", "tail"]
    pages = spark.createDataFrame([(1, "https://e.org/a", deep), (2, "https://e.org/b", unclosed)], "page_id long, url string, html string")
    rule = lambda root, url: [(len(root.walk()), len(list(root.find("a"))), dom.first(t for e in root.find("h1") for t in e.texts()))]     # noqa: E731
    got = sorted(map(tuple, dom.select_rows(pages, rule, "n int, links int, h1 string").select("page_id", "n", "links", "h1").collect()))
    assert got == [(1, 100_003, 1, "deep"), (2, 40_000, 10_000, None)]
    from habita.sources.pages import link_cards
    assert link_cards(pages).count() == 10_000


def test_join_stripped(spark):
    df = spark.createDataFrame([([" x ", "  ", "y"],)], "t array<string>")
    assert df.select(join_stripped("t")).first()[0] == "x y"


def test_location_split_matches_python(spark):
    texts = ["Bè, Lomé, Togo", "Adidogomé, Lomé", "Lomé", "A, B, C", "x,", "Togo, Lomé , Maritime Togo"]

    def ref(loc):
        if "," in loc:
            parts = [p.strip() for p in loc.split(",")]
            return parts[0], (parts[-2] if "Togo" in parts[-1] else parts[-1])
        return "", loc
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    h, c = split_location(F.col("x"))
    assert [tuple(r) for r in df.select(h, c).collect()] == [ref(t) for t in texts]


def test_pattern_lists(spark):
    t = ["villa 250 m² 4 pièces 2 wc", "surface : 300, 3 chambres", "120m2 1 toilette", "rien"]
    assert col(spark, t, surface_from_text) == ["250", "300", "120", None]
    assert col(spark, t, rooms_from_text) == ["4", "3", None, None]
    assert col(spark, t, wc_from_text) == ["2", None, "1", None]
    assert col(spark, ["ab 12 cd 3", "none"], first_integer) == ["12", None]


def test_title_and_legal_rules(spark):
    titles = ["Appartement villa", "Terrain maison", "STUDIO", "Immeuble", "x"]
    assert col(spark, titles, N.type_from_title_a) == ["Appartement", "Maison", "Autre", "Autre", "Autre"]
    assert col(spark, titles, N.type_from_title_b) == ["Appartement", "Terrain", "Studio", "Immeuble", "Autre"]
    assert col(spark, titles, lambda c: N.type_from_title_c(c)) == ["Villa", "Terrain", "Studio", "Autre", "Autre"]
    docs = ["Titre foncier et acte de vente", "PERMIS DE CONSTRUIRE", "", None]
    assert col(spark, docs, N.legal_docs_all) == ["Titre foncier, Acte de vente", "Permis de construire",
                                                  "Non spécifié", "Non spécifié"]
    assert col(spark, docs, N.legal_doc_first) == ["Titre foncier", "Permis de construire",
                                                   "Non spécifié", "Non spécifié"]
    assert col(spark, ["titre foncier"], N.capitalize) == ["Titre foncier"]


def test_host_allow_list(spark):
    urls = ["https://intendance.tg/x", "https://www.intendance.tg/", "https://evilintendance.tg/",
            "https://intendance.tg.evil.com/", "not a url"]
    got = col(spark, urls, lambda c: host_allowed(c, ["intendance.tg"]))
    assert got == [True, True, False, False, False]


def test_resolve_url_random_against_urljoin(spark):
    import random
    rnd = random.Random(7)
    parts = ["a", "b", "..", ".", "", "x.html", "é"]
    bases = ["https://h.example/d1/d2/f.html", "http://h.example/d1/", "https://h.example", "http://h.example/a/b/c?q#f"]
    refs = []
    for _ in range(400):
        segs = [rnd.choice(parts) for _ in range(rnd.randint(1, 6))]
        ref = ("/" if rnd.random() < 0.3 else "") + "/".join(segs)
        if rnd.random() < 0.2:
            ref += "?k=1"
        if rnd.random() < 0.1:
            ref += "#frag"
        refs.append(ref)
    pairs = [(rnd.choice(bases), r) for r in refs if not r.startswith("//")]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = [r[0] for r in df.select(resolve_url(F.col("b"), F.col("h"))).collect()]
    mism = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(pairs, got) if g != urljoin(b, h)]
    assert not mism, mism[:5]
