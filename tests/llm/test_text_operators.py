import hashlib
import random
import zlib

import numpy as np
import pytest

from habita.llm import embedding_dedup, minhash, reputation, toxicity, wrapper
from habita.session import read_table

from ..conftest import SF_SMALL
from . import brute


# fingerprints

def test_fingerprints_of_edits(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    got = minhash.fingerprint_edits(odd_docs).collect()
    assert len(got) == len(rows) and minhash.fingerprint_edits(no_docs).collect() == []
    # descending ids; the two rows of id 1 hold the same text, the null ids come last in either order
    order = sorted((i, t) for i, t in rows if i is not None)[::-1]
    nulls = [t for i, t in rows if i is None]
    by_text = {}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] != 1:
            k = next(k for k, (i, _) in enumerate(order) if i == r["doc_id"])
            t, n = order[k][1], order[k + 1][1]
            edited = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            a, b, c = brute.shingles(t), brute.shingles(edited), brute.shingles(n)
            for near, other in (("near_edited", b), ("near_next", c)):
                true = len(a & other) / len(a | other) if a | other else 1.0
                assert abs(r[near] - true) < 0.13, (r["doc_id"], near)
        text = dict(order).get(r["doc_id"]) if r["doc_id"] is not None else None
        if text is not None:
            assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert by_text[""] == "" and len(nulls) == 2


def test_texts_of_few_shingles_are_told_apart():
    """One shingle fills one bin and every other bin borrows it: the bins must still not hold the same bits."""
    for words, most in ((4, 0.2), (6, 0.2), (7, 0.25)):
        texts = [" ".join("w%d_%d" % (k, j) for j in range(words)) for k in range(2000)]
        codes, some = minhash.sketch(texts)
        assert len(set(minhash.pack(codes, some))) == 2000
        near = minhash.likeness(codes[:-1], some[:-1], codes[1:], some[1:])
        assert near.max() < most and near.mean() < 0.03
        again, _ = minhash.sketch(texts[:10])
        assert (again == codes[:10]).all()
    half, some = minhash.sketch(["a b c d e f", "a b c d e g"])      # one shingle of two is shared: a third of both
    assert abs(minhash.likeness(half[:1], some[:1], half[1:], some[1:])[0] - 1 / 3) < 0.35


def test_the_last_document_takes_from_the_first(spark):
    docs = spark.createDataFrame([(k, "abcdefghi %d" % k) for k in range(50)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in minhash.fingerprint_edits(docs).collect()}
    for k in range(50):
        t, n = "abcdefghi %d" % k, "abcdefghi %d" % ((k - 1) % 50)
        assert got[k]["edited_sha256"] == hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()


def test_densified_estimate_is_unbiased():
    rnd = random.Random(1)
    errors = []
    for n in (3, 10, 60, 600, 3000):
        for _ in range(12):
            a = ["w%d" % rnd.randrange(10 ** 9) for _ in range(n + 4)]
            cut = rnd.randrange(n + 4)
            b = a[:cut] + ["v%d" % rnd.randrange(10 ** 9) for _ in range(n + 4 - cut)]
            x, some = minhash.sketch([" ".join(a), " ".join(b)])
            s, t = brute.shingles(" ".join(a)), brute.shingles(" ".join(b))
            errors.append(minhash.likeness(x[:1], some[:1], x[1:], some[1:])[0] - len(s & t) / len(s | t))
    assert abs(np.mean(errors)) < 0.05


# toxicity

def test_toxicity_finds_held_out_documents(spark, no_docs):
    rnd = random.Random(7)
    bad = ["scoundrel", "villain", "rotten", "beastly"]
    rows, marks = [], []
    for i in range(3000):
        words = ["n%d" % rnd.randrange(900) for _ in range(rnd.randrange(5, 80))]
        toxic = i % 9 == 0
        if toxic:
            for w in rnd.sample(bad, 3):
                words.insert(rnd.randrange(len(words)), w)
        rows.append((i, " ".join(words), "en", 1.0, "b"))
        if i % 2 == 0:
            marks.append((i, 1, int(toxic)))
    rows += [(9001, None, None, None, None), (9002, "", None, None, None), (None, "scoundrel villain rotten x", None, None, None), (0, rows[0][1], "en", 1.0, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, bag string")
    labels = spark.createDataFrame(marks + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    tested = [(r["doc_id"] % 9 == 0, r["predicted"] == 1) for r in got if r["held_out"] and r["doc_id"] < 3000]
    assert sum(y and p for y, p in tested) >= 0.95 * sum(y for y, _ in tested)
    assert sum(not y and p for y, p in tested) <= 0.02 * len(tested)
    assert next(r["predicted"] for r in got if r["doc_id"] is None) == 1
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(d) for d in docs.collect() if not next(
        r["predicted"] for r in got if r["doc_id"] == d["doc_id"] and (r["doc_id"] is not None or True)))
    # without labels nothing is toxic
    none = toxicity.score_documents(docs, labels.where("false")).collect()
    assert len(none) == len(rows) and not any(r["predicted"] for r in none)
    assert toxicity.score_documents(no_docs, labels).collect() == []


def test_risk_stays_corrected():
    """Positives hidden among the unlabelled do not pull the classifier towards clean."""
    rnd = np.random.default_rng(0)
    make = lambda toxic: np.unique(np.concatenate([rnd.integers(100, 2000, 20), [7, 8] if toxic else []]).astype(np.uint64))     # noqa: E731
    pos, unl = [make(True) for _ in range(80)], [make(k % 5 == 0) for k in range(600)]
    names, w, b = toxicity.train(pos, unl, 0.2)
    logit = lambda f: b + w[np.isin(names, f)].sum()        # noqa: E731
    assert np.mean([logit(make(True)) > np.log(0.3 / 0.7) for _ in range(100)]) > 0.97
    assert np.mean([logit(make(False)) > np.log(0.3 / 0.7) for _ in range(100)]) < 0.03


# main text

PAGES = [
    ("<html><body><div class='site-header'>Logo</div><div class='wrap'><div id=content><h2>T</h2><p>Hello <a href=x>w</a>orld &amp; all&nbsp;x</p><ul><li>one<li>two</ul>"
     "<div class='comments'><p>bad</p></div></div><div class=sidebar>x</div></div><div class='cookie-notice'>We use</div></body></html>", "T\nHello world & all x\none\ntwo"),
    ("<p>only", "only"), ("", ""), (None, ""), ("x &lt; y &#8217; <b", "x < y ’ <b"),
    ("<article><header><h1>A</h1></header><p>b<br>c</p><section class='comments'><article class=comment>no</article></section><form>f</form></article><p>out</p>", "A\nb c"),
    ("<main><p>m</p><script>var a='</p>'</script><style>p{}</style></main><footer>f</footer>", "m"),
    ("<div class=top>Site</div><main><div class=head><h1>T</h1></div><p>m</p></main><div class=x>y</div>", "T\nm"),
    ("<div>Site</div><article><div class='post-header'><h1>T</h1></div><div class=ad>a</div><p>m</p></article>", "T\nm"),
    ("<nav><ul><li>a</li></ul></nav><article><h1>H</h1><p><b>x.<br><p>y</p></article>", "H\nx.\ny"),
]


def test_main_text_of_single_pages(spark):
    pages = spark.createDataFrame([(k, "http://h%d.org/x" % k, h, "t", 5) for k, (h, _) in enumerate(PAGES)] + [(None, None, "<p>z", None, None)],
                                  "page_id long, url string, html string, template string, host int")
    got = {r["page_id"]: r for r in wrapper.main_texts(pages).collect()}
    assert got[None]["text"] == "z" and got[None]["url"] is None
    for k, (_, text) in enumerate(PAGES):
        assert got[k]["text"] == text and got[k]["n_chars"] == len(text), k
    assert wrapper.main_texts(pages.where("false")).collect() == []


def test_template_of_a_host_without_marked_article(spark):
    """Same frame on every page, no telling names: constant nodes and link lists go, varying text stays."""
    rnd = random.Random(3)
    rows, want = [], {}
    for k in range(40):
        para = [" ".join("w%d" % rnd.randrange(500) for _ in range(30)) for _ in range(rnd.randrange(1, 5))]
        body = "".join(f"<p>{p}</p>" for p in para)
        links = "".join(f"<li><a href=/{rnd.random()}>l{rnd.randrange(99)}</a></li>" for _ in range(4))
        rows.append((k, "https://one.example/p/%d" % k, f"<html><body><div class=top>My site</div><div class=x><ul>{links}</ul></div><div class=y>{body}</div><div class=z>Always the same line</div></body></html>"))
        want[k] = "\n".join(para)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r["page_id"]: r["text"] for r in wrapper.main_texts(pages).collect()} == want


def test_deep_and_unclosed_pages_give_their_text(spark):
    """100,000 nested elements, 10,000 unclosed ones, and deep furniture: no page fails the table."""
    text = "<article><h1>Head</h1><p>Long enough running text of a page.</p></article>"
    deep = {1: "<div>" * 100_000 + text + "</div>" * 100_000, 2: "<div>" * 100_000 + text, 3: "<ul><li>" * 20_000 + "item", 4: "<b>" * 50_000 + "bold",
            5: "<p>a <span>" * 10_000, 6: "<div>" * 300 + "<nav>" + "<div>" * 300 + "menu" + "</div>" * 300 + "</nav>" + text, 7: "</x>" * 50_000 + text,
            8: "<section class=a>" * 5_000 + "words" + "</section>" * 5_000}
    pages = spark.createDataFrame([(i, "https://h%d.org/" % (i % 3), h) for i, h in deep.items()], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrapper.main_texts(pages).collect()}
    article = "Head\nLong enough running text of a page."
    assert {k: got[k] for k in (1, 2, 6, 7)} == {1: article, 2: article, 6: article, 7: article}
    assert got[3] == "item" and got[4] == "bold" and got[8] == "words" and got[5].split() == ["a"] * 10_000
    assert wrapper.main_texts(pages, sent_bytes=0).count() == 8


def test_one_host_sent_or_joined(spark):
    """All pages are one host's: whether templates are sent or joined in parts, the texts are the same."""
    page = lambda k: f"<div class=top>menu</div><div class=note>constant line</div><div class=body><h1>T{k}</h1><p>own text of page {k}, long enough</p></div>"     # noqa: E731
    pages = spark.createDataFrame([(k, "https://one.org/%d" % k, page(k)) for k in range(60)], "page_id long, url string, html string").repartition(7)
    want = {k: f"T{k}\nown text of page {k}, long enough" for k in range(60)}
    for sent in (wrapper.SENT_BYTES, 0):
        assert {r["page_id"]: r["text"] for r in wrapper.main_texts(pages, sent).collect()} == want


def test_merging_templates_does_not_depend_on_grouping():
    pages = [f"<div class=a>same</div><div class=b><p>{k}</p>{'<i>q</i>' * (k % 3)}</div>" for k in range(9)]
    one = lambda p: wrapper.new_template(wrapper.Fold("#root", [wrapper.parse(p)]))     # noqa: E731
    all_in_turn = one(pages[0])
    for p in pages[1:]:
        wrapper.merge(all_in_turn, one(p))
    halves = [one(pages[0]), one(pages[5])]
    for k, p in enumerate(pages):
        if k not in (0, 5):
            wrapper.merge(halves[k > 5], one(p))
    both = wrapper.merge(*halves)
    assert both["n"] == all_in_turn["n"] == 9 and wrapper._running(both) == wrapper._running(all_in_turn)


def _words(rnd, n):
    return " ".join("w%d" % rnd.randrange(500) for _ in range(n))


def _of_one_host(spark, made):
    """Main texts of pages of one host, and what they should be."""
    pages = spark.createDataFrame([(k, "https://one.example/p/%d" % k, h) for k, (h, _) in enumerate(made)], "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in wrapper.main_texts(pages).collect()}
    for k, (_, want) in enumerate(made):
        assert got[k] == want, k


def test_constant_lines_inside_a_marked_article(spark):
    """An unnamed block and a line among the paragraphs, the same on every page, go; a constant word in a varying line stays."""
    rnd, made = random.Random(4), []
    for k in range(40):
        para = [_words(rnd, 30) for _ in range(rnd.randrange(1, 9))]
        own = "".join(f"<p><b>Note:</b> {p}</p>" for p in para)
        made.append((f"<html><body><article><h1>{k} title</h1>{own}<p>Always the same line.</p><div class=x>Tell <a href=/a>friends</a> of it</div></article></body></html>",
                     "\n".join([f"{k} title"] + [f"Note: {p}" for p in para])))
    _of_one_host(spark, made)


def test_teasers_are_not_main_text(spark):
    """Articles in another place, of another class, beside or inside the main one."""
    rnd = random.Random(5)
    for shape in ("<article>{a}</article><div class=more>{t}</div>", "<div class=q>{t}</div><article class=post>{a}</article>", "<article>{a}</article>{t}",
                  "<article>{a}<div class=q>{t}</div></article>", "<div class=content>{a}</div><div class=q>{t}</div>"):
        made = []
        for k in range(20):
            para = [_words(rnd, 30) for _ in range(rnd.randrange(3, 6))]
            teasers = "".join(f"<article><h3><a href=/{rnd.random()}>{_words(rnd, 4)}</a></h3><p>{_words(rnd, 8)}</p></article>" for _ in range(3))
            made.append(("<body>" + shape.format(a="".join(f"<p>{p}</p>" for p in para), t=teasers) + "</body>", "\n".join(para)))
        _of_one_host(spark, made)


def test_named_slots_of_an_article_stay(spark):
    """Ids and classes with a furniture word in them; whole names go only if constant or mostly links, comments and adverts always."""
    rnd, made = random.Random(6), []
    for frame in ("<article>%s</article>", "<main>%s</main>"):
        for k in range(20):
            w = [_words(rnd, 12) for _ in range(9)]
            made.append(("<body>" + frame % (
                f"<h2 id='discussion'>{w[0]}</h2><h2 id='legal-history'>{w[1]}</h2><section id='search-methods'><p>{w[2]}</p></section><p class='notice-period'>{w[3]}</p>"
                f"<ul class='tags'><li>{w[4]}</li></ul><p>{w[5]} <span class=notice>{w[6]}</span> <span class=share>Pass it on</span></p><div class='share-box'><a href=/{k}>{w[7]}</a></div>"
                f"<div class=newsletter>Write your address here</div><div class=advert>{w[8]}</div><div class='comment-list'><p>{w[8]}</p></div>") + "</body>",
                "\n".join([*w[:5], f"{w[5]} {w[6]}"])))
        _of_one_host(spark, made)
        made.clear()


def test_named_slots_without_a_template():
    page = "<article><h2 id='discussion'>A</h2><section id='search-methods'>b</section><p class='notice-period'>c</p><ul class=tags><li>d</ul><ul class=related><li><a href=x>e</a></ul></article>"
    assert wrapper.extract(page, None) == "A\nb\nc\nd"


def test_copies_of_one_article_stay_whole(spark):
    copy = ("<article><h1>T</h1><p>one two three</p><p>four five six</p></article>", "T\none two three\nfour five six")
    near = ("<article><h1>T</h1><p>one two three</p><p>four five seven</p></article>", "T\none two three\nfour five seven")
    _of_one_host(spark, [copy] * 30 + [near])


# reputation

def test_rules_and_parts(spark):
    urls = {"http://A.Example.com/en/x?q": ("a.example.com", "/en/x", "example.com/en/", "block"), "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://x.www.example.com/en/a#b": ("x.www.example.com", "/en/a", "www.example.com/en/", "allow"), "http://example.com": ("example.com", "", None, "allow"),
            "http://other.com/en/": ("other.com", "/en/", "com/", "allow"), "ftp://q.net/es/1": ("q.net", "/es/1", "net/es/", "block"), "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
            "http://q.net/de/": ("q.net", "/de/", None, "allow"), "no scheme.com/en/": ("", "", None, "allow"), "http://xcom/": ("xcom", "/", None, "allow"), "": ("", "", None, "allow"),
            None: ("", "", None, "allow"), "http://É.com?x": ("É.com", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow")}
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, n int")
    labels = spark.createDataFrame([(99, 1, 0)], "doc_id long, quality int, toxic int")       # labels no page
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.judge_urls(pages, labels).collect()}
    for k, u in enumerate(urls):
        assert got[k] == urls[u], u
    assert reputation.judge_urls(pages.where("false"), labels.where("false")).collect() == []


def test_bad_hosts_are_blocked_by_the_bound(spark):
    rows, marks = [], []
    for h, (n, bad) in enumerate([(60, 50), (60, 6), (2, 2), (0, 0), (60, 7), (60, 5), (200, 22), (50, 6)]):
        for k in range(max(n, 1)):
            i = h * 1000 + k
            rows.append((i, f"http://h{h}.d{h}.org/{k}"))
            if k < n:
                marks.append((i, int(k >= bad), 0))
    got = {r["host"]: r for r in reputation.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()}
    assert got["h0.d0.org"]["verdict"] == "block" and all(got[f"h{h}.d{h}.org"]["verdict"] == "allow" for h in (1, 3, 4, 5, 6, 7))
    assert got["h2.d2.org"]["bad_mean"] < 1.0        # two pages are shrunk towards the rest
    assert got["h0.d0.org"]["bad_mean"] < 50 / 60 and got["h3.d3.org"]["bad_low"] < got["h3.d3.org"]["bad_mean"]


# embeddings

def brute_links(rows, least=0.98):
    ok = [(i, np.array(v, np.float64), y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for a in range(len(ok)):
        for b in range(a + 1, len(ok)):
            (i, x, p), (j, z, q) = ok[a], ok[b]
            if p == q and len(x) == len(z) and x @ z / np.sqrt((x @ x) * (z @ z)) >= least:
                links.append((i, j))
    return links


def test_vectors_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for c in range(30):
        centre = rnd.normal(size=24)
        for _ in range(int(rnd.integers(1, 12))):
            v = (centre + rnd.normal(size=24) * rnd.choice([0.01, 0.08, 0.14])).astype(np.float32)
            rows.append((len(rows), v.tolist(), int(c % 3)))
    hot = rnd.normal(size=24).astype(np.float32)
    rows += [(len(rows) + k, (hot + rnd.normal(size=24).astype(np.float32) * 0.01).tolist(), 1) for k in range(600)]
    n = len(rows)
    rows += [(n, hot.tolist(), 1), (n + 1, hot.tolist(), 1), (n + 2, None, 1), (n + 3, [], 1), (n + 4, [0.0] * 24, 1), (n + 5, [float("nan")] * 24, 1),
             (n + 6, [None] + hot.tolist()[1:], 1), (n + 7, hot.tolist(), None), (n + 8, hot.tolist()[:12], 1), (n + 9, [float("inf")] * 24, 1), (None, hot.tolist(), 1)]
    df = spark.createDataFrame([(*r, 3, "k") for r in rows], "vec_id long, embedding array<float>, label int, bucket int, keys string").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link_vectors(df).collect()}
    links = brute_links([(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, y) for i, v, y in rows])
    count = {i: 0 for i, _, _ in rows if i is not None}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    comp = brute.components(count, links)
    assert got.pop(None) == (0, None, True)
    assert sum(g[0] for g in got.values()) >= 0.99 * 2 * len(links)
    assert all(g[0] <= count[i] for i, g in got.items())
    assert np.mean([got[i] == (count[i], comp[i], comp[i] == i) for i in count]) > 0.99
    assert embedding_dedup.link_vectors(df.where("false")).collect() == []


def test_vectors_of_one_name_each_keep_their_links(spark):
    """Two different vectors named 7 lie close to each other and to a third; two others named 5 link with different vectors."""
    base = np.random.default_rng(3).normal(size=16)
    far = np.random.default_rng(4).normal(size=16)
    near = lambda v, k: [float(x) for x in (v + np.eye(16)[k] * 0.02).astype(np.float32)]       # noqa: E731
    rows = [(7, near(base, 0)), (7, near(base, 1)), (3, near(base, 2)), (5, near(base, 3)), (5, near(far, 0)), (9, near(far, 1))]
    got = embedding_dedup.link_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(3, 3, 3), (5, 1, 5), (5, 3, 3), (7, 3, 3), (7, 3, 3), (9, 1, 5)]


def test_rotation_keeps_lengths_and_matches_the_matrix():
    x = np.random.default_rng(0).normal(size=(5, 16))
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(embedding_dedup.fast_hadamard(x), x @ h)
    assert np.allclose((embedding_dedup.rotate(x, 3) ** 2).sum(1), (x ** 2).sum(1))
