import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from habita.llm import queries, spelling
from habita.session import read_table

from ..conftest import SF_CHECK, SF_SMALL
from . import brute


def brute_counts(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(brute.UPPER, brute.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return out


def brute_variants(counts):
    """Neighbours by what is left when one code point is taken out, compared pair by pair."""
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    meet = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            meet[w[:k] + w[k + 1:]].add(w)
        meet[w].add(w)
    pairs = {(a, b) for group in meet.values() for a in group for b in group if a != b and abs(len(a) - len(b)) <= 1 and near(a, b)}
    by = defaultdict(list)
    for a, b in pairs:
        by[a].append(b)
    form = {}
    for w, others in by.items():
        best = min(others, key=lambda t: (-counts[t], t))
        if counts[best] >= 5 * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(by[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def listed(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_CHECK])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    counts = {w: n for w, n in brute_counts(rows).items() if len(w) >= 6 and n >= 5}
    assert listed(queries.queries()["op12_spelling_variants"](spark, sf_dir)) == brute_variants(counts)


def test_counts_of_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert dict(map(tuple, spelling.count_words(odd_docs).collect())) == brute_counts(rows)
    assert listed(spelling.spelling_variants(no_docs)) == []


def word_list(seed, longest):
    rnd = random.Random(seed)
    counts = {}
    for _ in range(60):
        w = "".join(rnd.choice("abé") for _ in range(rnd.randrange(1, longest)))
        counts[w] = rnd.randrange(1, 4000)
        for _ in range(6):
            k, c = rnd.randrange(len(w) + 1), rnd.choice("abcé")
            v = rnd.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])
            if v:
                counts[v] = rnd.choice([1, 5, 30, 600])
                w = rnd.choice([w, v])
    return counts


@pytest.mark.parametrize("seed, small_table, longest", [(1, 100, 14), (2, 0, 14), (3, 100, 4), (4, 0, 7)])
def test_all_edits_broadcast_or_shuffled_short_or_long(spark, seed, small_table, longest):
    counts = word_list(seed, 14)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert listed(spelling.group_variants(words, small_table, longest)) == brute_variants(counts)


def test_a_word_as_long_as_a_text(spark):
    rnd = random.Random(8)
    w = "".join(rnd.choice("acgt") for _ in range(20000))
    counts = {w: 5000, w[:700] + w[701:]: 40, w[:9000] + "é" + w[9001:]: 7, w[:9000] + "x" + w[9001:]: 8, w + "y": 5, "y" + w + "y": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert listed(spelling.group_variants(words)) == brute_variants(counts)


def test_keys_of_rests():
    whole, rest = spelling.rest_keys("abécaab")
    assert rest.tolist() == [spelling.rest_keys("abécaab"[:k] + "abécaab"[k + 1:])[0] for k in range(7)]
    assert whole not in rest.tolist() and len(set(rest.tolist())) == 6      # "aa": either one leaves the same


def test_chains_of_forms(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "cccccc": 5, "cccccd": 24}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r for r in spelling.group_variants(words).collect()}
    assert {got[w]["root"] for w in counts if w[0] == "a"} == {"abbbbb"} and got["cccccc"]["form"] is None
    assert listed(spelling.group_variants(words)) == brute_variants(counts)
