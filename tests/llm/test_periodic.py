import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from habita.llm import periodic, queries, recompression
from habita.session import read_table

from ..conftest import SF_SMALL


def brute_runs(words):
    """Maximal stretches with smallest period q, at least max(6, 4 q) long: every period, word by word."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= 4 * q:
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, l, q) for (s, l), q in out.items() if l >= 6)


def brute_row(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = brute_runs(words)
    gone = [False] * len(words)
    for s, l, q in runs:
        gone[s + q:s + l] = [True] * (l - q)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()      # noqa: E731
    return (i, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for w, g in zip(words, gone) if not g)))


def strings(seed, n=400):
    rnd = random.Random(seed)
    for _ in range(n):
        kind = rnd.randrange(4)
        if kind == 0:
            yield [rnd.randrange(2) for _ in range(rnd.randrange(60))]
        elif kind == 1:
            u = [rnd.randrange(3) for _ in range(rnd.randrange(1, 6))]
            yield (u * rnd.randrange(1, 12) + [rnd.randrange(3) for _ in range(rnd.randrange(6))]) * rnd.randrange(1, 4)
        elif kind == 2:
            yield [0] * rnd.randrange(50) + [1] * rnd.randrange(3) + [0] * rnd.randrange(50)
        else:                                           # Fibonacci words: many runs of many periods
            a, b = [0], [0, 1]
            while len(b) < rnd.randrange(1, 200):
                a, b = b, b + a
            yield b


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_one_batch_equal_brute_force(seed):
    texts = list(strings(seed))
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    flat = np.array([x for t in texts for x in t], np.int32)
    doc, start, length, q = periodic.find_runs(flat, begin)
    got = [[] for _ in texts]
    for d, s, l, p in zip(doc.tolist(), start.tolist(), length.tolist(), q.tolist()):
        got[d].append((s, l, p))
    for t, g in zip(texts, got):
        assert g == brute_runs(t)


def test_extensions_equal_symbol_by_symbol():
    rnd = random.Random(3)
    text = [x for t in strings(9, 60) for x in t]
    marked = np.array([0, *(x + 2 for x in text), 1], np.int32)
    levels = recompression.grammar(marked, 2, 5)
    assert sum(s >= 2 for s in levels[-1].symbols) == 1 and {lv.step for lv in levels} == {recompression.BLOCKS, recompression.PAIRS, None}
    pairs = [sorted(rnd.sample(range(1, len(text) + 1), 2)) for _ in range(3000)]
    pairs += [(i, i + d) for d in (1, 2, 3, 5) for i in range(1, len(text) - 5, 3)]
    i, j = (np.array(x) for x in zip(*pairs))
    for back in (False, True):
        got = recompression.common_extension(levels, i, j, back)
        for a, b, g in zip(i, j, got):
            n = 0
            while marked[a] == marked[b]:
                n, a, b = n + 1, a + (-1 if back else 1), b + (-1 if back else 1)
            assert g == n


def test_the_grammar_is_smaller_than_a_periodic_text():
    marked = np.concatenate([[0], np.tile(np.arange(2, 9), 20000), [1]]).astype(np.int32)
    levels = recompression.grammar(marked, 2, 9)
    assert sum(len(lv.symbols) for lv in levels) < 6 * len(marked)
    assert len(levels[-1].symbols) == 3


def test_query_equals_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    want = sorted(brute_row(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 20000)
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == docs.count() and [got[w[0]] for w in want] == want
    assert sum(w[1] > 0 for w in want) > 10


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = periodic.digest_runs(periodic.mark_runs(periodic.tile_tails(odd_docs))).collect()
    key = lambda r: tuple((x is None, x) for x in r)        # noqa: E731
    short = [(i, t) for i, t in rows if len(t or "") < 50000]
    assert sorted((tuple(r) for r in got if r["doc_id"] != 9), key=key) == sorted((brute_row(i, t) for i, t in short), key=key)
    assert len(got) == len(rows)
    empty = periodic.digest_runs(periodic.mark_runs(periodic.tile_tails(no_docs)))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_a_long_text_of_one_word_and_a_long_period(spark):
    unit = ["w%d" % (k * 7919 % 30011) for k in range(30000)]
    texts = [(1, "a " * 300000), (2, " ".join(unit * 5)), (3, "x y x y x y x y x y x y")]
    got = {r["doc_id"]: r for r in periodic.mark_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 300000, 1)] and got[1]["collapsed"] == "a"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 150000, 30000)] and got[2]["collapsed"] == " ".join(unit)
    assert [tuple(r) for r in got[3]["runs"]] == [(0, 6, 1)]
