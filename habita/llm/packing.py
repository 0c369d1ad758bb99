"""Best-fit packing by patterns: non-negative least squares on the length histogram.

Lengths are counted into ``UNITS`` bins. Every way to fill a sequence with at
most ``DEPTH`` pieces (as bins) is a pattern; non-negative least squares finds
how often each pattern should be repeated to use up the histogram. The counts
are rounded down and realised with exact lengths; what is left goes, longest
first, into the tightest gap that holds it, or opens a new sequence. All of
this happens on the histogram (one number per possible length, whatever the
size of the data); pieces then look up their place by length and rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, text_rows
from .tokens import BATCH_ROWS, encoder, slices, tokenizer_path

MAX_TOKENS = 2048
END_ID = 0
UNITS = 64
DEPTH = 4


def patterns(units: int = UNITS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` bins that fill ``units`` exactly."""
    out = []

    def extend(head, left, most):
        if left == 0:
            out.append(head)
        elif len(head) < depth:
            for b in range(min(most, left), 0, -1):
                extend((*head, b), left - b, b)
    extend((), units, units)
    return out


def nnls(a: np.ndarray, y: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Lawson-Hanson active set: the x >= 0 that minimises |a x - y|."""
    x = np.zeros(a.shape[1])
    active = np.zeros(len(x), bool)
    scale = max(1.0, float(np.abs(y).max(initial=0.0)))
    for _ in range(rounds):
        slope = a.T @ (y - a @ x)
        slope[active] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-9 * scale:
            break
        active[j] = True
        while True:
            z = np.zeros(len(x))
            z[active] = np.linalg.lstsq(a[:, active], y, rcond=None)[0]
            if z[active].min(initial=1.0) > 1e-12:
                x = z
                break
            low = active & (z <= 1e-12)
            step = np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))
            x = x + step * (z - x)
            active &= x > 1e-12
            x[~active] = 0.0
            if not active.any():
                break
    return x


def plan(histogram: np.ndarray, limit: int = MAX_TOKENS, units: int = UNITS, depth: int = DEPTH) -> dict[str, np.ndarray]:
    """Places for ``histogram[length]`` pieces of each length 1..limit.

    Returns arrays ``length, rank, count, sequence, offset``: the pieces of that
    length with ranks rank..rank+count-1 go to sequences sequence.. at offset.
    """
    left = histogram.astype(np.int64).copy()
    taken = np.zeros(limit + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)     # gap -> (first sequence, how many)
    sizes: list[int] = []                                          # gaps in use, ascending
    opened = 0

    def put(length, count, sequence, used):
        rows.append((length, int(taken[length]), count, sequence, used))
        taken[length] += count
        left[length] -= count

    def offer(gap, sequence, count):
        if gap > 0 and count > 0:
            if not gaps[gap]:
                bisect.insort(sizes, gap)
            gaps[gap].append((sequence, count))

    bin_of = -(-np.arange(limit + 1) * units // limit)
    full = np.bincount(bin_of[1:], weights=left[1:], minlength=units + 1)[1:]
    ways = patterns(units, depth)
    if full.sum() > 0 and limit >= units:
        a = np.zeros((units, len(ways)))
        for j, w in enumerate(ways):
            for b in w:
                a[b - 1, j] += 1
        weight = np.sqrt(np.arange(1, units + 1) / units)      # a long piece left over costs more
        repeats = np.floor(nnls(a * weight[:, None], full * weight) + 1e-6).astype(np.int64)
        lengths_in = {b: np.nonzero(bin_of == b)[0][::-1] for b in range(1, units + 1)}
        for j in np.argsort(-repeats, kind="stable"):
            todo = int(repeats[j])
            while todo > 0:
                need: dict[int, int] = defaultdict(int)
                run, pick = todo, []
                for b in ways[j]:
                    if len(pick) + 1 < len(ways[j]) or not pick:    # the longest remaining piece of the pattern's bin
                        found = next((int(v) for v in lengths_in[b] if v and left[v] > need[v]), 0)
                    else:                   # the last part: whatever fills the sequence best
                        room = limit - sum(pick)
                        found = next((int(v) for v in np.nonzero(left[:room + 1])[0][::-1] if v and left[v] > need[v]), 0)
                    if not found:
                        run = 0
                        break
                    need[found] += 1
                    pick.append(found)
                if run:
                    run = min([run, *(int(left[v]) // k for v, k in need.items() if k)])
                if not run:
                    break
                used = 0
                for v in pick:
                    put(v, run, opened, used)
                    used += v
                offer(limit - used, opened, run)
                opened += run
                todo -= run
    for v in range(limit, 0, -1):
        while left[v] > 0:
            n = int(left[v])
            i = bisect.bisect_left(sizes, v)
            if i < len(sizes):
                gap = sizes[i]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(i)
            else:
                gap, first, count = limit, opened, max(1, n // (limit // v))
                opened += count
            m = min(n, count)
            copies = max(1, min(gap // v, n // m))
            for c in range(copies):
                put(v, m, first, limit - gap + c * v)
            offer(gap - copies * v, first, m)
            offer(gap, first + m, count - m)
    out = np.array(rows, np.int64).reshape(-1, 5)
    out = out[np.lexsort((out[:, 1], out[:, 0]))]
    return dict(zip(("length", "rank", "count", "sequence", "offset"), out.T))


PIECES = "pid int, doc_id long, piece int, start long, length int, ids_crc32 long, local long"


def _pieces(path: str, end_id: int, limit: int):
    def run(batches):
        pid = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                ids, off = encoder(path).encode(part.column("text"), end_id)
                n = np.diff(off)
                per = -(-n // limit)
                doc = np.repeat(np.arange(len(n)), per)
                k = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
                length = np.minimum(limit, n[doc] - k * limit)
                # rank of each piece among this task's pieces of the same length
                order = np.argsort(length, kind="stable")
                _, first, count = np.unique(length[order], return_index=True, return_counts=True)
                local = np.empty(len(doc), np.int64)
                local[order] = seen[length[order]] + np.arange(len(doc)) - np.repeat(first, count)
                seen += np.bincount(length, minlength=limit + 1)
                raw = ids.astype("<u4")
                at = off[:-1][doc] + k * limit
                crc = [zlib.crc32(raw[a:a + m]) for a, m in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), pid, np.int32)), part.column("doc_id").take(pa.array(doc)),
                     pa.array(k.astype(np.int32)), pa.array(k * limit), pa.array(length.astype(np.int32)),
                     pa.array(crc, pa.int64()), pa.array(local)],
                    names=["pid", "doc_id", "piece", "start", "length", "ids_crc32", "local"])
    return run


def _place(table):
    def run(batches):
        t = table.value
        key = t["length"] << 40 | t["rank"]
        for pdf in batches:
            rank = pdf["first"].to_numpy() + pdf["local"].to_numpy()
            i = np.searchsorted(key, pdf["length"].to_numpy().astype(np.int64) << 40 | rank, side="right") - 1
            yield pdf.drop(columns=["first", "local", "pid"]).assign(
                sequence_id=t["sequence"][i] + rank - t["rank"][i], offset=t["offset"][i])
    return run


def pack_documents(docs: DataFrame, tokenizer: str | None = None, limit: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    A document is its ids and ``end_id``; only one longer than ``limit`` is cut,
    into pieces of ``limit`` and a rest. Null or empty text: the end id alone.
    Rows with a null or repeated ``doc_id`` are documents of their own; extra
    columns are ignored; an empty table gives no rows. Returns doc_id, piece,
    start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()
    pieces = materialize(text_rows(docs).mapInArrow(_pieces(path, end_id, limit), PIECES), "pieces", BATCH_ROWS)
    counts = pieces.groupBy("pid", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():      # at most `limit` rows
        histogram[r["length"]] = r["n"]
    table = spark.sparkContext.broadcast(plan(histogram, limit))                 # bounded by `limit`, not by the data
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = pieces.join(first, ["pid", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "pid", "local", "first")
    return placed.mapInPandas(_place(table), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
