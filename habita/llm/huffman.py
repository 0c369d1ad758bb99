"""Token ids as length-limited canonical Huffman code, in independent blocks.

Ids are counted over all documents; package-merge gives the best code lengths
of at most ``LONGEST`` bits and the codes are canonical, so the lengths alone
rebuild them. A block holds whole documents and a checkpoint (bit offset) every
``STEP`` ids; a reader decodes all stretches between checkpoints side by side
with one table look-up per id, and any block without the others.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import U64, discard, materialize, parts_for, release, text_rows, total_bytes
from .tokens import BATCH_ROWS, encoder, slices, tokenizer_path

END_ID = 1
LONGEST = 20
STEP = 512
BLOCK_IDS = 1 << 20
PART_BYTES = 16 << 20


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Package-merge: best prefix-code lengths of at most ``longest`` bits (0: id not used)."""
    used = np.nonzero(counts)[0]
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    rows, weight = [], leaf
    for _ in range(longest):
        is_leaf = np.ones(len(weight), bool) if not rows else np.concatenate([np.ones(len(leaf), bool), np.zeros(len(weight) - len(leaf), bool)])[by]
        rows.append(is_leaf)
        pairs = weight[:len(weight) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaf, pairs])
        by = np.argsort(merged, kind="stable")
        weight = merged[by]
    take = 2 * len(leaf) - 2
    length = np.zeros(len(leaf) + 1, np.int64)
    for is_leaf in reversed(rows):
        leaves = int(is_leaf[:take].sum())
        length[0] += 1
        length[leaves] -= 1
        take = 2 * (take - leaves)
    out[order] = np.cumsum(length)[:-1]
    return out


def canonical(lengths: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Code of each id, and the decoding table: entry of the next ``longest`` bits -> id << 5 | length."""
    used = np.nonzero(lengths)[0]
    order = used[np.argsort(lengths[used], kind="stable")]
    span = np.int64(1) << (longest - lengths[order].astype(np.int64))
    first = np.cumsum(span) - span
    codes = np.zeros(len(lengths), np.uint32)
    codes[order] = first >> (longest - lengths[order].astype(np.int64))
    table = np.zeros(1 << longest, np.uint32)
    entry = order.astype(np.uint32) << np.uint32(5) | lengths[order]
    filled = np.repeat(entry, span)
    table[:len(filled)] = filled
    return codes, table


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray]:
    """Bits of all ids, and the bit offset of every ``step``-th."""
    if not len(ids):
        return b"", np.empty(0, np.uint32)
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    word = at >> 6
    room = 64 - (at & 63)
    code = codes[ids].astype(U64)
    out = np.zeros(int(end[-1] >> 6) + 2, U64)
    fits = room >= n
    shift = np.where(fits, room - n, n - room).astype(U64)
    begin = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1])
    out[word[begin]] = np.bitwise_or.reduceat(np.where(fits, code << shift, code >> shift), begin)
    over = np.nonzero(~fits)[0]
    out[word[over] + 1] |= code[over] << (U64(64) - shift[over])
    return out.astype(">u8").tobytes()[:int(end[-1] + 7 >> 3)], at[::step].astype(np.uint32)


def decode(payload: bytes, count: int, checkpoints: np.ndarray, table: np.ndarray, step: int = STEP, longest: int = LONGEST) -> np.ndarray:
    """The ``count`` ids of a block; every stretch between checkpoints is one lane."""
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    peek = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    lanes = len(checkpoints)
    out = np.zeros((step, lanes), np.uint32)
    at = checkpoints.astype(np.int64)
    tail = count - (lanes - 1) * step           # ids in the last lane
    low, mask, top = 32 - longest, np.uint32((1 << longest) - 1), len(peek) - 1
    for k in range(min(step, count)):
        if k == tail:
            at = at[:-1]
        i = np.minimum(at >> 3, top)
        got = table[peek[i] >> (low - (at & 7)).astype(np.uint32) & mask]
        out[k, :len(at)] = got >> np.uint32(5)
        at += (got & np.uint32(31)).astype(np.int64)
    return out.T.reshape(-1)[:count]


RAW = "kind int, bucket int, doc_ids binary, sizes binary, data binary, n long"
NO_ID = -2 ** 63


def _tokenise(path: str, end_id: int, cuts: np.ndarray):
    """Scan order: ids per range of doc_id, and at the end this task's counts of each id."""
    def run(batches):
        counts = np.zeros(1, np.int64)
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                ids, off = encoder(path).encode(part.column("text"), end_id)
                seen = np.bincount(ids)
                if len(seen) > len(counts):
                    counts, seen = seen.astype(np.int64), counts
                counts[:len(seen)] += seen
                doc = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                size = np.diff(off)
                where = np.where(doc == NO_ID, -1, np.searchsorted(cuts, doc, side="right"))
                by = np.argsort(where, kind="stable")
                cut = np.nonzero(np.diff(where[by]))[0] + 1
                rows = {k: [] for k in ("kind", "bucket", "doc_ids", "sizes", "data", "n")}
                for group in np.split(by, cut):
                    group = group[np.argsort(doc[group], kind="stable")]
                    own = np.concatenate([ids[off[i]:off[i + 1]] for i in group])
                    own = own.astype("<u2" if own.max() < 1 << 16 else "<u4")
                    planes = own.view(np.uint8).reshape(len(own), -1).T.tobytes()      # low bytes together, high bytes together
                    for k, v in (("kind", 0), ("bucket", int(where[group[0]])), ("doc_ids", doc[group].astype("<i8").tobytes()),
                                 ("sizes", size[group].astype("<i8").tobytes()), ("data", squeeze.compress(planes)), ("n", len(own))):
                        rows[k].append(v)
                yield _arrow(rows)
        used = np.nonzero(counts)[0]
        if len(used):
            yield _arrow({"kind": [1], "bucket": [0], "doc_ids": [used.astype("<i8").tobytes()],
                          "sizes": [counts[used].astype("<i8").tobytes()], "data": [b""], "n": [len(used)]})
    return run


def _arrow(rows: dict) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "bucket": pa.int32(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()], names=list(rows))


def _unpack_counts(batches):
    for pdf in batches:
        for i, c in zip(pdf["doc_ids"], pdf["sizes"]):
            yield pd.DataFrame({"id": np.frombuffer(i, "<i8"), "n": np.frombuffer(c, "<i8")})


BLOCKS = "bucket int, block int, start long, n_ids long, doc_ids binary, sizes binary, checkpoints binary, payload binary"


def _encode_bucket(tables, starts):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths, codes = tables.value
        unzip = zstandard.ZstdDecompressor()
        parts = []
        for i, s, d, n in zip(pdf["doc_ids"], pdf["sizes"], pdf["data"], pdf["n"]):
            planes = np.frombuffer(unzip.decompress(d, max_output_size=4 * int(n)), np.uint8).reshape(-1, int(n))
            own = np.ascontiguousarray(planes.T).view("<u2" if len(planes) == 2 else "<u4").ravel().astype("<u4")
            parts.append((np.frombuffer(i, "<i8"), np.frombuffer(s, "<i8"), own))
        doc = np.concatenate([p[0] for p in parts])
        size = np.concatenate([p[1] for p in parts])
        ids = np.concatenate([p[2] for p in parts])
        off = np.cumsum(size) - size
        crc = np.array([zlib.crc32(ids[a:a + n]) for a, n in zip(off.tolist(), size.tolist())])
        order = np.lexsort((crc, size, doc))          # equal doc_ids: by size and content
        bucket = int(pdf["bucket"].iloc[0])
        start, rows, a = starts.value[bucket], [], 0
        ends = np.cumsum(size[order])
        while a < len(order):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_IDS, side="right")))
            own = np.concatenate([ids[off[i]:off[i] + size[i]] for i in order[a:b]])
            payload, marks = encode(own, lengths, codes)
            rows.append((bucket, len(rows), start, len(own), doc[order[a:b]].astype("<i8").tobytes(),
                         size[order[a:b]].astype("<i8").tobytes(), marks.astype("<u4").tobytes(), payload))
            start += len(own)
            a = b
        return pd.DataFrame(rows, columns=["bucket", "block", "start", "n_ids", "doc_ids", "sizes", "checkpoints", "payload"])
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of all documents (null text: empty, then ``end_id`` each) as Huffman blocks under ``path``.

    ``path/blocks/bucket=N`` hold ranges of ``doc_id`` in ascending order (nulls
    first; rows sharing a ``doc_id`` ordered by size and content), ``path/code``
    the code length of every used id. Only id counts, totals of ranges and the
    code lengths reach the driver: bounded by vocabulary and number of ranges.
    """
    spark = docs.sparkSession
    rows = text_rows(docs)
    n = parts_for(spark, total_bytes(rows), PART_BYTES)
    cuts = np.array(sorted(set(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (8 * n)))) if n > 1 else [], np.float64).astype(np.int64)
    raw = materialize(rows.mapInArrow(_tokenise(tokenizer or tokenizer_path(), end_id, cuts), RAW), "ids", BATCH_ROWS)
    counted = raw.where("kind = 1").select("doc_ids", "sizes").mapInPandas(_unpack_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in counted], default=0) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes, _ = canonical(lengths)
    starts, total = {}, 0
    for r in raw.where("kind = 0").groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect():
        starts[r["bucket"]] = total
        total += r["n"]
    share = spark.sparkContext.broadcast
    (raw.where("kind = 0").repartition(n, "bucket").groupBy("bucket").applyInPandas(release(_encode_bucket(share((lengths, codes)), share(starts))), BLOCKS)
     .write.partitionBy("bucket").option("compression", "none").parquet(f"{path}/blocks"))
    discard(raw)
    used = np.nonzero(lengths)[0]
    spark.createDataFrame(pd.DataFrame({"id": used, "bits": lengths[used].astype(np.int64)}), "id long, bits long").coalesce(1).write.parquet(f"{path}/code")


def _decode_blocks(table):
    def run(batches):
        for pdf in batches:
            for start, n, i, s, marks, payload in zip(pdf["start"], pdf["n_ids"], pdf["doc_ids"], pdf["sizes"], pdf["checkpoints"], pdf["payload"]):
                ids = decode(payload, int(n), np.frombuffer(marks, "<u4"), table.value).astype("<u4")
                doc, size = np.frombuffer(i, "<i8"), np.frombuffer(s, "<i8")
                at = np.cumsum(size) - size
                yield pd.DataFrame({"doc_id": pd.array(doc, "Int64").copy() if not (doc == NO_ID).any() else pd.array([None if d == NO_ID else int(d) for d in doc], "Int64"),
                                    "start": start + at, "n_tokens": size,
                                    "ids_crc32": [zlib.crc32(ids[a:a + m]) for a, m in zip(at.tolist(), size.tolist())]})
    return run


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files under ``path``: doc_id, start, n_tokens, ids_crc32, from the decoded ids."""
    code = spark.read.schema("id long, bits long").parquet(f"{path}/code").collect()      # bounded by the vocabulary
    lengths = np.zeros(max([r["id"] for r in code], default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]
    table = spark.sparkContext.broadcast(canonical(lengths)[1])
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("start", "n_ids", "doc_ids", "sizes", "checkpoints", "payload")
    return blocks.mapInPandas(release(_decode_blocks(table)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def roundtrip(docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Write the documents' ids and read them back. An empty table gives no rows; extra columns are ignored."""
    path = path or scratch_path(docs.sparkSession, "llm-tokens")
    write_ids(docs, path, tokenizer)
    return read_ids(docs.sparkSession, path)
