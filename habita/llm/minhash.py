"""Document fingerprints: one-permutation MinHash with optimal densification.

Every word shingle is hashed once; the top bits choose one of ``BINS`` bins, a
bin keeps its smallest hash. An empty bin borrows from the bin that a fixed
2-universal sequence reaches first among the filled ones (the same sequence for
every text, so equal bins borrow alike). Of each bin's hash, with the bin's number
mixed in, only the low ``BITS`` bits are stored; the likeness of two fingerprints takes the share of equal bins and
removes what chance agreement of ``BITS`` bits adds.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import U64, mix64, parts_for, shingle_hashes, text_rows, total_bytes

BINS = 512        # a power of two
BITS = 4          # low-order bits kept of each bin
PROBES = 8192     # steps of the borrowing sequence before the nearest filled bin to the right is taken
PART_BYTES = 24 << 20
MOST_PARTS = 8192 # ranges at most: their bounds are found and held on the driver; larger ranges are read as streams all the same


@lru_cache(maxsize=2)
def _probe_table(bins: int, probes: int) -> np.ndarray:
    step = np.arange(probes, dtype=U64)[:, None] * U64(0xD6E8FEB86659FD93)
    return (mix64(step + np.arange(bins, dtype=U64)[None, :] * U64(0x9E3779B97F4A7C15) + U64(1)) >> U64(33)).astype(np.int64) % bins


def densify(mins: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Fill the empty bins of rows that have at least one filled bin."""
    out = mins.copy()
    bins = mins.shape[1]
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    table = _probe_table(bins, PROBES)
    for t in range(PROBES):
        if not len(row):
            return out
        src = table[t][col]
        hit = filled[row, src]
        out[row[hit], col[hit]] = mins[row[hit], src[hit]]
        row, col = row[~hit], col[~hit]
    for r, c in zip(row, col):
        full = np.nonzero(filled[r])[0]
        out[r, c] = mins[r, full[np.searchsorted(full, c) % len(full)]]
    return out


def sketch(texts: list[str], bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits of every bin, one row per text, and which texts have any shingle."""
    h, off = shingle_hashes(pa.array(texts, pa.large_string()))
    n = len(texts)
    mins = np.full(n * bins, np.iinfo(np.uint64).max, U64)
    shift = U64(64 - int(bins).bit_length() + 1)
    doc = np.repeat(np.arange(n), np.diff(off))
    np.minimum.at(mins, doc * bins + (h >> shift).astype(np.int64), h)
    mins = mins.reshape(n, bins)
    some = np.diff(off) > 0
    filled = mins != np.iinfo(np.uint64).max
    full = densify(mins, filled)
    # a borrowed hash stands in several bins: with the bin's number mixed in, its bits there are independent
    number = mix64(np.arange(1, bins + 1, dtype=U64))
    return (mix64(full ^ number[None, :]) & U64((1 << bits) - 1)).astype(np.uint8), some


def pack(codes: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Base64 of the bins' bits, first bin in the highest bits; no shingle: the empty string."""
    planes = np.unpackbits(codes[:, :, None], axis=2)[:, :, 8 - bits:]
    raw = np.packbits(planes.reshape(len(codes), -1), axis=1)
    return [base64.b64encode(r.tobytes()).decode() if s else "" for r, s in zip(raw, some)]


def likeness(a, some_a, b, some_b, bits: int = BITS) -> np.ndarray:
    """Estimated shingle-set likeness in [0, 1], chance agreement removed; two empty sets: 1, one: 0."""
    chance = 2.0 ** -bits
    est = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0) if len(a) else np.empty(0)
    return np.where(some_a & some_b, est, (some_a == some_b).astype(float))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _rows(ids: list, texts: list[str], following: str) -> pd.DataFrame:
    """Result rows of consecutive documents; ``following`` is the text after the last one."""
    nexts = [*texts[1:], following]
    edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for t, n in zip(texts, nexts)]
    own, some = sketch([*texts, following])
    ed, some_ed = sketch(edited)
    return pd.DataFrame({
        "doc_id": pd.array(ids, dtype="Int64"),
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": pack(own[:-1], some[:-1]),
        "edited_fingerprint": pack(ed, some_ed),
        "near_edited": likeness(own[:-1], some[:-1], ed, some_ed),
        "near_next": likeness(own[:-1], some[:-1], own[1:], some[1:]),
    })


def _walk(batches):
    """Rows arrive bucket by bucket in descending order, each bucket ended by a borrowed row."""
    held: list[tuple] = []          # rows of the current bucket whose follower is not known yet
    for pdf in batches:
        for i, text, borrowed in zip(pdf["doc_id"], pdf["text"], pdf["borrowed"]):
            if borrowed:
                if held:
                    yield _rows([h[0] for h in held], [h[1] for h in held], text)
                held = []
                continue
            held.append((None if pd.isna(i) else int(i), text))
            if len(held) > 400 or sum(len(h[1]) for h in held[-8:]) > 4_000_000:
                yield _rows([h[0] for h in held[:-1]], [h[1] for h in held[:-1]], held[-1][1])
                held = held[-1:]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text.

    Edited: the last third (floor, in code points) replaced by as many first
    code points of the next document in descending ``doc_id`` order (after the
    last one: the first). Null text is empty; an empty set of shingles has the
    empty fingerprint. Rows with a null ``doc_id`` come last; rows that share a
    ``doc_id`` follow each other in the order of a hash of their text. Extra
    columns are ignored; an empty table gives no rows.

    The table is cut into ranges of ``doc_id`` at quantiles and shuffled once;
    the one document a range needs from its neighbour is added to it first.
    """
    rows = text_rows(docs)
    spark = docs.sparkSession
    n = min(parts_for(spark, total_bytes(rows), PART_BYTES), MOST_PARTS)
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (8 * n)))) if n > 1 else []
    cuts = [int(c) for c in cuts]
    bucket = (F.when(F.col("doc_id").isNull(), F.lit(-1))
              .otherwise(F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<long>"), lambda c: c <= F.col("doc_id")))))
    if len(cuts) > 64:   # long arrays of cuts: one comparison chain per row would be slow
        bounds = spark.sparkContext.broadcast(np.array(cuts, np.int64))

        @F.pandas_udf("int")
        def locate(ids: pd.Series) -> pd.Series:
            return pd.Series(np.where(ids.isna(), -1, np.searchsorted(bounds.value, ids.fillna(0).astype("int64"), side="right")))
        bucket = locate("doc_id")
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), bucket.cast("int").alias("bucket"))
    # first row of each bucket (descending), handed to the bucket above; the topmost goes to the lowest
    heads = rows.groupBy("bucket").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-2 ** 63)).alias("k"), "tie")).alias("head"))
    up = Window.orderBy("bucket")
    heads = heads.select("bucket", "head.k", "head.tie",
                         F.coalesce(F.lead("bucket").over(up), F.min("bucket").over(Window.orderBy(F.lit(1)))).alias("to"))
    lent = (rows.join(F.broadcast(heads.select("bucket", F.col("k").alias("hk"), F.col("tie").alias("ht"), "to")), "bucket")
            .where((F.coalesce("doc_id", F.lit(-2 ** 63)) == F.col("hk")) & (F.col("tie") == F.col("ht")))
            .dropDuplicates(["bucket"])
            .select("doc_id", "text", "tie", F.col("to").alias("bucket"), F.lit(True).alias("borrowed")))
    both = rows.withColumn("borrowed", F.lit(False)).unionByName(lent)
    dealt = (both.repartition(n, "bucket")
             .sortWithinPartitions("bucket", "borrowed", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
             .select("doc_id", "text", "borrowed"))
    return dealt.mapInPandas(_walk, SCHEMA)
