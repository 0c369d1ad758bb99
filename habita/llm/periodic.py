"""Periodic runs: stretches of consecutive words that repeat with a period.

A run is a stretch whose smallest period q gives a length of at least
``max(LEAST, TIMES * q)`` words and that no neighbouring word extends. A run of
period q covers at least ``TIMES`` points of the grid of multiples of q in its
document, so of the neighbouring grid points every third pair is a candidate
and every run holds one: n/q candidates for each q, a harmonic sum. How far the
two places of a candidate agree in both directions is asked of the
run-length grammar of ``recompression``, which gives the run's exact ends; there
is no suffix array. A multiple of the smallest period gives the same ends, so
the smallest period per stretch is kept.

Documents are worked on where they are read, some megabytes at a time: nothing
is shuffled, and a document is never split nor joined with another.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import release
from .recompression import common_extension, grammar
from .tokens import slices

LEAST = 6               # words a run has at least
TIMES = 4               # repetitions a run has at least
SLICE = 3 << 20         # bytes of text whose documents share one grammar
CANDIDATES = 1 << 20    # candidates asked at a time
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts (runs of bytes other than ASCII white space) and where each text's begin, and the end."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = pc.list_flatten(lists)
    begin = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    filled = pc.not_equal(words, "")            # splitting leaves empty strings at the ends of a text
    seen = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return words.filter(filled), seen[begin]


def _candidates(begin: np.ndarray, size: np.ndarray):
    """Pairs of places (i, i + q), in blocks: every third pair of neighbouring grid points for every period a document allows."""
    doc = np.repeat(np.arange(len(size)), size // TIMES)
    if not len(doc):
        return
    first = np.cumsum(size // TIMES) - size // TIMES
    q = np.arange(len(doc)) - first[doc] + 1
    step = (TIMES - 1) * q
    count = (size[doc] - q + step - 1) // step          # i = 0, step, ... with i + q inside
    ends = np.cumsum(count)
    cuts = np.searchsorted(ends, np.arange(CANDIDATES, ends[-1] + CANDIDATES, CANDIDATES))
    a = 0
    for b in np.unique(np.minimum(cuts + 1, len(doc))):
        n = count[a:b]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(begin[doc[a:b]], n) + nth * np.repeat(step[a:b], n)
        yield i, np.repeat(q[a:b], n)
        a = b


def find_runs(symbols: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period.

    ``symbols[begin[d]:begin[d + 1]]`` are document d's words as numbers from 0.
    """
    docs, size = len(begin) - 1, np.diff(begin)
    marks = docs + 1
    marked = np.insert(symbols.astype(np.int32) + np.int32(marks), begin, np.arange(marks, dtype=np.int32))
    names = int(marked.max()) + 1
    levels = grammar(marked, marks, names)
    at = begin[:-1] + np.arange(docs) + 1
    found = []
    for i, q in _candidates(at, size):
        same = marked[i] == marked[i + q]
        i, q = i[same], q[same]
        ahead = common_extension(levels, i, i + q)
        behind = common_extension(levels, i, i + q, back=True) - 1
        length = ahead + behind + q
        ok = length >= TIMES * q
        found.append(np.stack([i[ok] - behind[ok], length[ok], q[ok]]))
    start, length, q = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])       # the smallest period of each stretch
    one &= length >= LEAST
    start, length, q = start[one], length[one], q[one]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    doc = np.searchsorted(at, start, side="right") - 1
    return doc, start - at[doc], length, q


def _mark(batches):
    for batch in batches:
        for part in slices(batch, size=SLICE):
            words, begin = _split(part.column("text"))
            coded = words.dictionary_encode()
            symbols = coded.indices.to_numpy(zero_copy_only=False)
            doc, start, length, q = find_runs(symbols, begin)
            # a word goes if some run contains it after that run's first period
            change = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(change, begin[doc] + start + q, 1)
            np.add.at(change, begin[doc] + start + length, -1)
            kept = np.cumsum(change[:-1]) == 0
            stays = np.concatenate([[0], np.cumsum(kept)])[begin]
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(stays, pa.int32()), words.filter(pa.array(kept)).cast(pa.string())), " ")
            per_doc = np.searchsorted(doc, np.arange(len(begin)))
            runs = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, q)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(begin), pa.int64()), pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), runs),
                 collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


def mark_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    ``runs``: start (word number from 0), length and smallest period of every
    run, by start, then period. ``collapsed``: the words, joined by one space,
    without those that a run contains after its first period. A null text has no
    words, no runs and an empty collapsed text, like an empty one. Rows with a
    null ``doc_id`` and rows that repeat one are worked on each by itself; extra
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(release(_mark), FOUND)


def _tile(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k, i in enumerate(batch.column("doc_id").to_pylist()):
            h = zlib.crc32(b"%d" % i) if i is not None else 1
            words = (texts[k] or "").encode().split() if h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                unit = words[a:a + p]
                words[a:] = (unit * ((n - a) // p + 1))[:n - a]
                texts[k] = b" ".join(words).decode()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def tile_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a planted repetition in the documents whose ``crc32(doc_id)`` 10 divides.

    From word a on, such a text repeats its p words from a (a and p follow from
    the checksum). Rows with a null ``doc_id``, and texts without words, stay as
    they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tile, "doc_id long, text string")


def _longest(runs: str) -> Column:
    """Of ``runs`` the one with the greatest length / period, the first of equals."""
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]      # noqa: E731
    return F.aggregate(runs, F.element_at(runs, 1), lambda best, r: F.when(more(best, r), r).otherwise(best))


def digest_runs(found: DataFrame) -> DataFrame:
    """Number of runs, the run that repeats most often and checksums, of the rows of ``mark_runs``."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = F.when(F.size("runs") > 0, _longest("runs"))
    return (found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))
