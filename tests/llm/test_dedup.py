import hashlib
import random

import numpy as np
import pytest

from habita.llm import components, parity_join, suffix_array, suffix_dedup
from habita.session import read_table

from ..conftest import SF_SMALL
from . import brute


def known(df):
    return [(r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is not None]


@pytest.mark.parametrize("small", [32, 0, 1 << 20])
def test_suffix_array_against_sorting(small, monkeypatch):
    monkeypatch.setattr(suffix_array, "SMALL", small)       # 0: always by waves, large: always singly
    rnd = random.Random(3)
    for _ in range(300):
        k = rnd.choice([1, 2, 3, 200])
        t = [rnd.randint(1, k) for _ in range(rnd.choice([0, 1, 2, 9, 60]))]
        t = np.array((t[:len(t) // 3 + 1] * 3 if rnd.random() < 0.3 else t) + [0])
        assert suffix_array.suffix_array(t, k + 1).tolist() == sorted(range(len(t)), key=lambda i: tuple(t[i:]))


def test_suffix_array_of_six_megabytes(spark):
    """Hundreds of thousands of names: every neighbour pair of the array is in order, by its first byte and the order of what follows."""
    raw = " ".join(r["text"] or "" for r in read_table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()).encode()
    t = np.append(np.frombuffer((raw * 3)[:6 << 20], np.uint8).astype(np.int64) + 2, 0)
    sa = suffix_array.suffix_array(t, 258)
    rank = np.full(len(t), -1)
    rank[sa] = np.arange(len(t))
    assert (rank >= 0).all() and sa[0] == len(t) - 1
    a, b = sa[1:-1], sa[2:]
    assert ((t[a] < t[b]) | (t[a] == t[b]) & (rank[a + 1] < rank[b + 1])).all()


def digests(df, popular=suffix_dedup.POPULAR):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.digest_without_repeats(df, popular).collect()]


@pytest.mark.parametrize("popular", [suffix_dedup.POPULAR, 1])
def test_repeats_against_brute_force(odd_docs, popular):
    texts = known(odd_docs)
    want = brute.without_repeats(texts)
    got = digests(odd_docs, popular)
    assert len(got) == odd_docs.count()
    sizes = dict((i, len((t or "").encode())) for i, t in texts)
    for i, n, removed, spans, sha in got:
        if i is not None:
            kept, runs = want[i]
            assert (n, removed, spans, sha) == (sizes[i], sizes[i] - len(kept), runs, hashlib.sha256(kept).hexdigest()), i
        else:
            assert removed == spans == 0        # without an id there is no order


def test_repeats_empty_table(no_docs):
    assert digests(no_docs) == []


def test_remove_repeats_keeps_columns(odd_docs):
    out = suffix_dedup.remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    rows = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert rows[2]["text"] == "" and rows[2]["n_chars"] == 0
    assert rows[17]["text"] == "" and rows[15]["text"] == "x" * 49


def linked(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in parity_join.link_documents(df).collect()}


def test_near_duplicates_against_brute_force(odd_docs):
    # every row by its place, with or without an id: a component is the smallest known id among its rows
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    sets = {k: brute.shingles(t) for k, (_, t) in enumerate(rows)}
    same_id = [(a, b) for a in sets for b in sets if a < b and rows[a] == rows[b] and rows[a][0] is not None]
    comp = brute.components(sets, brute.near_links(sets) + same_id)
    least = {}
    for k, c in comp.items():
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    got = [tuple(r) for r in parity_join.link_documents(odd_docs).collect()]
    assert sorted(got, key=str) == sorted(((i, len(sets[k]), least.get(comp[k])) for k, (i, _) in enumerate(rows)), key=str)
    assert any(i is None and least.get(comp[k]) == 10 for k, (i, _) in enumerate(rows))


def test_near_duplicates_on_a_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    texts = dict(known(docs))
    sets = {i: brute.shingles(t) for i, t in texts.items()}
    comp = brute.components(sets, brute.near_links(sets))
    assert linked(docs) == {(i, len(s), comp[i]) for i, s in sets.items()}


def test_near_duplicates_empty_table(no_docs):
    assert linked(no_docs) == set()


def test_near_copies_around_the_threshold(spark):
    """Many sizes, likeness just above and below, in one large lane of copies (several blocks of pairs)."""
    rnd = random.Random(9)
    rows, i = [], 0
    for n in (5, 6, 9, 12, 17, 31, 40, 63, 64, 90, 130):
        base = ["b%d_%d" % (n, k) for k in range(n)]
        for cut in range(0, max(2, n // 6)):
            words = base[:n - cut] + ["t%d_%d_%d" % (n, cut, k) for k in range(cut)]
            rows.append((i, " ".join(words)))
            i += 1
        for _ in range(4):
            words = [w if rnd.random() > 0.03 else "r%d" % rnd.randrange(10 ** 6) for w in base]
            rows.append((i, " ".join(words)))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: brute.shingles(t) for i, t in rows}
    comp = brute.components(sets, brute.near_links(sets))
    assert linked(docs) == {(i, len(s), comp[i]) for i, s in sets.items()}


def test_every_linked_pair_shares_a_lookup_lane():
    """The pigeonhole bound: whatever the order of lanes, prefixes of linked sets meet."""
    rnd = np.random.default_rng(1)
    for _ in range(200):
        n = int(rnd.integers(1, 200))
        a = rnd.integers(1, 2 ** 63, n).astype(np.uint64)
        drop = int(rnd.integers(0, max(1, n // 7) + 1))
        b = np.concatenate([a[drop // 2:], rnd.integers(1, 2 ** 63, drop - drop // 2).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        found = []
        for s in (a, b):
            key, owner, use, (_, g_use, filled, differ) = parity_join.lane_entries(s, np.array([0, len(s)]))
            mine = set()
            for u, d in zip(g_use, differ):
                mine |= set(np.sort(key[use == u])[:d + 1].tolist())
            found.append(mine)
        assert found[0] & found[1]


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(60, 100)] + [(rnd.randrange(50), rnd.randrange(50)) for _ in range(30)] + [(200, 200), (7, 3), (3, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.components({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_for_two_texts(spark):
    a, b, c = "a" * 10 + "first passage of more than fifty bytes, long enough to count", "b" * 90, "c" * 70
    rows = [(1, a), (2, "x " + a), (2, b + c), (3, b), (4, c + " tail")]
    got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"]) for r in suffix_dedup.digest_without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, len(a)): (0, 0), (2, len(a) + 2): (len(a), 1), (2, 160): (0, 0), (3, 90): (90, 1), (4, 75): (70, 1)}


@pytest.mark.parametrize("middle", [7, None])
def test_documents_linked_through_a_row_without_an_id(spark, middle):
    """5 and 9 are each near the row in the middle only; whether that has an id or not, all three are one group."""
    base = ["w%d" % k for k in range(200)]
    one, far = ["x"] + base[1:], base[:-1] + ["y"]
    for k in range(0, 14):              # both differ from the middle in other places
        one[k * 2], far[199 - k * 2] = "x%d" % k, "y%d" % k
    rows = [(5, " ".join(one)), (middle, " ".join(base)), (9, " ".join(far)), (None, "quite another text than those"), (None, "quite another text than those")]
    near = brute.near_links({k: brute.shingles(t) for k, (_, t) in enumerate(rows[:3])})
    assert near == [(0, 1), (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in parity_join.link_documents(docs).collect()), key=str)
    assert got == sorted([(5, 5), (middle, 5), (9, 5), (None, None), (None, None)], key=str)
