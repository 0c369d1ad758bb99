"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

U64 = np.uint64
BATCH_ROWS = 1000


def text_rows(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null becomes empty); every other column is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def spare_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to differ from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Few rows per Arrow batch while something is written: texts are long, and both sides hold whole batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with small_batches(spark, batch_rows):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(run):
    """Give freed memory back to the system after each batch or group of a function that runs in tasks.

    A Python worker outlives its task; without this it keeps the most it ever used.
    """
    def trim():
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    def per_group(pdf):
        out = run(pdf)
        trim()
        return out

    def per_batch(batches):
        for out in run(batches):
            yield out
            trim()
        trim()
    return per_batch if inspect.isgeneratorfunction(run) else per_group


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, total: int | None, per_part: int) -> int:
    """Partitions so that each holds about ``per_part`` of ``total``, at least the session's number."""
    return max(shuffle_partitions(spark), math.ceil((total or 0) / per_part))


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one number, for sizing partitions only."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def shingle_hashes(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct word shingles of each text, as (hashes, offsets).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A
    text with fewer than ``width`` words has its whole word sequence as its one
    shingle, a text without words none. ``hashes[offsets[i]:offsets[i + 1]]``
    are text i's, sorted.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = pc.list_flatten(lists)
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    # splitting leaves empty strings at the ends of a text
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    seen = np.concatenate([[0], np.cumsum(filled)])
    starts = seen[starts]
    coded = words.filter(pa.array(filled)).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh64_intdigest, pc.ascii_lower(coded.dictionary).to_pylist()), dtype=U64, count=len(coded.dictionary))
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, U64)
    n_words = np.diff(starts)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - width + 1, 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    odd = list(mix64(np.arange(1, width + 1, dtype=U64)) | U64(1))      # unrelated odd factors, one per place
    total = int(offsets[-1])
    doc = np.repeat(np.arange(len(n_words)), counts)
    first = starts[:-1][doc] + (np.arange(total) - offsets[:-1][doc])
    padded = np.concatenate([h, np.zeros(width, U64)])
    rolled = sum(padded[k:len(h) + k] * odd[k] for k in range(width))
    out = mix64(rolled[first]) if total else np.empty(0, U64)
    for i in np.nonzero((n_words > 0) & (n_words < width))[0]:      # a short text: its words only
        own = h[starts[i]:starts[i + 1]]
        out[offsets[i]] = mix64(np.array([(own * np.array(odd[:len(own)], U64)).sum(dtype=U64) + U64(len(own))], U64))[0]
    # distinct per text: sort by (text, hash) through one sort per text
    keep = np.ones(len(out), bool)
    for i in np.nonzero(counts > 1)[0]:
        a, b = offsets[i], offsets[i + 1]
        s = np.sort(out[a:b])
        out[a:b] = s
        keep[a + 1:b] = s[1:] != s[:-1]
    sizes = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], sizes[offsets]
