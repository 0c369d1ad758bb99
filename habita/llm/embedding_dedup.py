"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the axis (with sign) it then lies closest to. A table
joins as many hashes as the size of the largest label asks for. Besides its own
bucket a vector stands in the bucket it would have fallen into next (the hash
with the closest runner-up). Vectors of one label that share a bucket are
compared by exact cosine; a bucket with many vectors is gone through in blocks.
A pair is counted in the first bucket that it shares, so counts need no list of
pairs, and each block hands on one edge per vector for the components.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import U64, discard, materialize, mix64
from .components import connected_components

LIKENESS = 0.98
TABLES = 4
PROBES = 2              # buckets per table and vector: its own and the runner-up's
BUCKET = 64             # vectors of the largest label that a bucket should hold
BLOCK = 256


def fast_hadamard(x: np.ndarray) -> np.ndarray:
    """Unnormalised Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    d = x.shape[1]
    for k in range(3):
        signs = np.where(mix64(np.arange(d, dtype=U64) + U64((seed * 3 + k + 1) << 20)) >> U64(63), 1.0, -1.0)
        x = fast_hadamard(x * signs) / math.sqrt(d)
    return x


def bucket_keys(x: np.ndarray, hashes: int, tables: int = TABLES) -> np.ndarray:
    """Keys of the buckets of each vector: rows, tables, own and runner-up."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = x
    out = np.zeros((n, tables, PROBES), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        axes, seconds, gaps = [], [], []
        for k in range(hashes):
            y = rotate(padded, t * hashes + k)
            size = np.abs(y)
            top = size.argmax(axis=1)
            best = size[rows, top]
            size[rows, top] = -1.0
            nxt = size.argmax(axis=1)
            axes.append(2 * top + (y[rows, top] < 0))
            seconds.append(2 * nxt + (y[rows, nxt] < 0))
            gaps.append(best - size[rows, nxt])
        axes, seconds, gaps = np.stack(axes, 1), np.stack(seconds, 1), np.stack(gaps, 1)
        other = axes.copy()
        weak = gaps.argmin(axis=1)
        other[rows, weak] = seconds[rows, weak]
        for p, code in enumerate((axes, other)):
            key = np.full(n, t + 1, U64)
            for k in range(hashes):
                key = mix64(key * U64(0x9E3779B97F4A7C15) + code[:, k].astype(U64))
            out[:, t, p] = key.view(np.int64) >> 1
    return out


PLACED = "label int, bucket long, name long, copies long, vector binary, keys binary"


def _place(hashes: int):
    def run(batches):
        for pdf in batches:
            for width, same in pdf.groupby(pdf["vector"].map(len), sort=False):
                x = np.stack([np.asarray(v, np.float64) for v in same["vector"]])
                keys = bucket_keys(x, hashes)
                raw = [r.astype("<f4").tobytes() for r in x]
                flat = keys.reshape(len(x), -1)
                carried = [r.astype("<i8").tobytes() for r in flat]
                for s in range(flat.shape[1]):
                    # vectors of different widths never meet
                    yield pd.DataFrame({"label": same["label"].to_numpy(), "bucket": flat[:, s] ^ width, "name": same["name"].to_numpy(),
                                        "copies": same["copies"].to_numpy(), "vector": raw, "keys": carried})
    return run


def _components(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest name reachable in a dense link matrix."""
    low = ids.copy()
    big = np.iinfo(np.int64).max
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], big).min(axis=1))
        if (new == low).all():
            return low
        low = new


def _compare(f: pd.DataFrame, likeness: float) -> pd.DataFrame:
    x = np.frombuffer(b"".join(f["vector"]), "<f4").reshape(len(f), -1).astype(np.float64)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    ids, copies, block = f["name"].to_numpy(), f["copies"].to_numpy(), f["block"].to_numpy()
    linked = x @ x.T >= likeness
    np.fill_diagonal(linked, False)
    if f["i"].iloc[0] != f["j"].iloc[0]:
        linked &= block[:, None] != block[None, :]
    rows = np.nonzero(linked.any(axis=1))[0]
    if not len(rows):
        return pd.DataFrame({"name": ids[:0], "n": copies[:0], "least": ids[:0]})
    linked = linked[np.ix_(rows, rows)]
    ids, copies = ids[rows], copies[rows]
    # count a pair only in the first bucket it shares
    keys = np.frombuffer(b"".join(f["keys"].iloc[rows]), "<i8").reshape(len(rows), -1, PROBES)
    width = x.shape[1]
    here = int(f["bucket"].iloc[0]) ^ width
    first = linked.copy()
    table = int(np.nonzero((keys[0] == here).any(axis=1))[0][0])
    for t in range(table + 1):
        for p in range(PROBES):
            for q in range(PROBES):
                both = keys[:, t, p][:, None] == keys[:, t, q][None, :]
                if t == table:
                    both &= keys[:, t, p][:, None] < here
                first &= ~both
    return pd.DataFrame({"name": ids, "n": first @ copies, "least": _components(linked, ids)})


def _links(likeness: float):
    """Rows arrive sorted by group (a bucket's block, or two of its blocks)."""
    names = ["label", "bucket", "i", "j"]

    def run(batches):
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(held):
                continue
            tail = (held[names] == held[names].iloc[-1]).all(axis=1).to_numpy()
            ready = held[~tail]
            for _, f in ready.groupby(names, sort=False):
                if len(f) > 1:
                    yield _compare(f, likeness)
            held = held[tail].reset_index(drop=True)
        if held is not None and len(held) > 1:
            yield _compare(held, likeness)
    return run


def link_vectors(embeddings: DataFrame, likeness: float = LIKENESS, bucket: int = BUCKET) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector.

    Compared: vectors of equal, non-null label and equal length. A vector that
    is null, empty, zero or holds a null or non-finite component links with
    nothing, as does one with a null ``vec_id`` (its component is null and it is
    kept). Equal vectors of a label are compared once and count as links of each
    other; rows that repeat a ``vec_id`` are distinct vectors with the same
    name. Extra columns are ignored; an empty table gives no rows.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<float>"), lambda v: v + F.lit(0.0).cast("float")).alias("vector"), F.col("label").cast("int").alias("label"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
             & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
             & F.exists("vector", lambda v: v != 0))
    good = rows.where(F.coalesce(sound, F.lit(False)))
    # equal vectors once, under the hash of label and vector; their smallest id is their part of the component's
    groups = materialize(good.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
                         .select("label", "vector", "vec_id", "copies", F.xxhash64("label", "vector").alias("name")), "vectors")
    largest = groups.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n"), F.max(F.lit(0))).first()[0] or 1
    width = groups.agg(F.max(F.size("vector"))).first()[0] or 1
    hashes = max(1, math.ceil(math.log(max(largest / bucket, 1)) / math.log(2 * max(2, width))))
    placed = materialize(groups.select("label", "vector", "name", "copies").mapInPandas(_place(hashes), PLACED).distinct(), "buckets")
    sizes = placed.groupBy("label", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    dealt = (placed.join(sizes, ["label", "bucket"])
             .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "name", "copies", "vector", "keys"))
    names = ["label", "bucket", "i", "j"]
    found = materialize(dealt.repartition(*names).sortWithinPartitions(*names).mapInPandas(_links(likeness), "name long, n long, least long"), "links")
    discard(placed)
    cc = connected_components(found.select(F.col("name").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("name").agg(F.sum("n").alias("n"))
    joined = (groups.join(counts, "name", "left").join(cc, F.col("name") == F.col("node"), "left")
              .select("name", "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "name").alias("component")))
    lowest = joined.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = joined.join(lowest, "component").select("name", "n_links", "component_id")
    marked = rows.select("vec_id", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", "vector")).alias("name"))
    out = marked.join(named, "name", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
