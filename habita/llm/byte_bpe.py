"""Byte-level BPE of whole texts: overlapping chunks, stitched where pre-token boundaries meet.

A pre-token's end depends on the text after its start only, so two passes over
one text that have one boundary in common have all later ones in common. Long
texts are cut into chunks, each with some text of the next one; every chunk is
pre-tokenised by itself, in parallel, as if a text began there. Where a chunk's
boundaries in the overlap meet those of the next chunk, the next one has
resynchronised: from that place on its pre-tokens are the whole text's. A seam
without a common boundary lies inside one long pre-token: the chunks on both
sides become one, and its seams are tried again until all are settled. The
pre-tokens between two seams are then merged pair by pair, least rank first.
Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import uuid
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, parts_for, release, text_rows
from .tokens import slices, tokenizer_path

RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 1 << 15         # code points of a chunk
OVERLAP = 1 << 10       # code points of the next chunk that a chunk ends with
LOOK = 4                # a boundary so many code points before the end of what a chunk sees does not depend on what follows
REMEMBERED = 400_000    # pre-tokens whose ids a worker keeps
SHORT = 64              # code points of pre-tokens that are kept
PART_CODE_POINTS = 8 << 20

ENCODED = "row string, doc_id long, part int, last boolean, ids binary"
CHUNKS = "row string, doc_id long, part int, next int, own int, text string"


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 and number per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: of all neighbours whose join has a rank, the least rank (the leftmost of equals) joins first."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))         # end of the part that begins at a place; 0 where none begins
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        rank = ranks.get(piece[i:j])
        if rank is not None:
            heapq.heappush(heap, (rank, i, j))
    while heap:
        _, i, j = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= j or end[middle] != j:
            continue                    # one of the two parts has joined another since
        end[i], end[middle] = j, 0
        if j < n:
            before[j] = i
            offer(i, end[j])
        if before[i] >= 0:
            offer(before[i], j)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def _ranges(points: np.ndarray) -> str:
    """A character class (without brackets) of the code points."""
    cuts = np.nonzero(np.diff(points) != 1)[0] + 1
    runs = [(int(r[0]), int(r[-1])) for r in np.split(points, cuts) if len(r)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def _library_classes(names=(r"\p{L}", r"\p{N}")) -> tuple[regex.Pattern, dict[str, str]]:
    """Code points that the tokenizer library and ``regex`` class differently (their Unicode versions differ), and the library's classes."""
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    odd, classes = set(), {}
    for name in names:
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = {ord(c) for c in probe.decode(probe.encode_ordinary(every))}
        odd |= theirs ^ {ord(c) for c in regex.findall(name, every)}
        classes[name] = f"[{_ranges(np.array(sorted(theirs)))}]"
    return regex.compile(f"[{_ranges(np.array(sorted(odd)))}]" if odd else r"(?!)"), classes


class _Remembered(dict):
    """Ids of pre-tokens as little-endian 32-bit numbers; a bounded number of short ones is kept."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = merge(piece.encode(), self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class ByteEncoder:
    """Pre-tokenises, encodes and decodes; one per Python worker and file."""

    def __init__(self, path: str, pattern: str):
        self.pattern = pattern
        self.plain = regex.compile(pattern)
        self.exact = self.odd = None
        ranks = read_ranks(path)
        self.ids = _Remembered(ranks)
        self.bytes = {rank: token for token, rank in ranks.items()}

    def _finder(self, text: str) -> regex.Pattern:
        if text.isascii():
            return self.plain
        if self.odd is None:
            self.odd, classes = _library_classes()
            exact = self.pattern
            for name, members in classes.items():
                exact = exact.replace(name, members)
            self.exact = regex.compile(exact, regex.V1)
        return self.exact if self.odd.search(text) else self.plain

    def pieces(self, text: str, start: int = 0, stop: int | None = None) -> list[str]:
        """Pre-tokens of ``text`` from the boundary ``start`` to the boundary ``stop``; what follows that still has a say in the last ones."""
        stop = len(text) if stop is None else stop
        end = min(len(text), stop + LOOK)
        found = self._finder(text).findall(text, start, end)
        while end > stop and found:
            end -= len(found.pop())
        return found

    def boundaries(self, text: str) -> np.ndarray:
        ends = np.cumsum([0, *map(len, self.pieces(text))])
        if ends[-1] != len(text):
            raise ValueError("the pattern leaves some text out")
        return ends

    def encode(self, text: str, start: int = 0, stop: int | None = None) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.pieces(text, start, stop)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, _numbers(packed)))


def _numbers(packed: bytes):
    """Little-endian 32-bit numbers, whatever this machine's order."""
    ids = array("I", packed) if array("I").itemsize == 4 else np.frombuffer(packed, "<u4").tolist()
    if isinstance(ids, array) and struct.pack("=I", 1) != struct.pack("<I", 1):
        ids.byteswap()
    return ids


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def encoder(path: str, pattern: str) -> ByteEncoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = ByteEncoder(path, pattern)
    return _encoders[path, pattern]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def _encode_whole(path: str, pat: str):
    """Documents of one chunk: encoded where they are read."""
    def run(batches):
        e = encoder(path, pat)
        for batch in batches:
            for piece in slices(batch):
                yield _batch(ENCODED, [(None, i, 0, True, e.encode(t)) for i, t in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist())])
    return run


def _cut(chunk: int, overlap: int):
    """Chunks of long texts; ``row`` names the text, ``own`` counts the code points before the overlap."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                i, text, row = batch.column("doc_id")[k].as_py(), batch.column("text")[k].as_py(), uuid.uuid4().hex
                parts = max(1, -(-(len(text) - overlap) // chunk))
                for p in range(parts):
                    last = p == parts - 1
                    here = text[p * chunk:] if last else text[p * chunk:(p + 1) * chunk + overlap]
                    yield _batch(CHUNKS, [(row, i, p, None if last else p + 1, len(here) if last else chunk, here)])
    return run


SEEN = "row string, part int, next int, head array<int>, tail array<int>"


def _seen(path: str, pat: str, overlap: int):
    """Boundaries of each chunk in its overlaps with the chunk before (``head``) and after (``tail``, counted from that chunk's start)."""
    def run(batches):
        e = encoder(path, pat)
        for batch in batches:
            for row, part, nxt, own, text in zip(*(batch.column(c).to_pylist() for c in ("row", "part", "next", "own", "text"))):
                b = e.boundaries(text)
                sure = b[b <= (len(text) if nxt is None else len(text) - LOOK)]
                yield _batch(SEEN, [(row, part, nxt, sure[sure <= overlap].tolist(), [] if nxt is None else (sure[sure >= own] - own).tolist())])
    return run


def _seams(seen: DataFrame) -> DataFrame:
    """``row, part, next, start``: where each chunk's pre-tokens begin to count; null where no boundary is shared."""
    tails = seen.where("next is not null").select("row", F.col("next").alias("part"), "tail")
    return (seen.select("row", "part", "next", "head").join(tails, ["row", "part"], "left")
            .select("row", "part", "next", F.when(F.col("part") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("head", "tail"))).alias("start")))


def _joined(chunks: DataFrame, seams: DataFrame) -> DataFrame:
    """Chunks with an unsettled seam between them as one chunk."""
    spans = seams.select("row", "part", F.max(F.when(F.col("start").isNotNull(), F.col("part")))
                         .over(Window.partitionBy("row").orderBy("part")).alias("span"))
    members = F.array_sort(F.collect_list(F.struct("part", "next", "own", "text")))
    return (chunks.join(spans, ["row", "part"]).groupBy("row", "doc_id", "span").agg(members.alias("m"))
            .withColumn("end", F.element_at("m", -1))
            .select("row", "doc_id", F.col("span").alias("part"), F.col("end.next").alias("next"),
                    (F.aggregate("m", F.lit(0), lambda n, c: n + c["own"])).alias("own"),
                    F.concat(F.array_join(F.transform(F.expr("slice(m, 1, size(m) - 1)"), lambda c: F.substring(c["text"], F.lit(1), c["own"])), ""),
                             F.col("end.text")).alias("text")))


PLACED = "row string, doc_id long, part int, last boolean, text string, start int, stop int"


def _encode_spans(path: str, pat: str):
    def run(batches):
        e = encoder(path, pat)
        for batch in batches:
            for row, i, part, last, text, start, stop in zip(*(batch.column(c.split()[0]).to_pylist() for c in PLACED.split(", "))):
                yield _batch(ENCODED, [(row, i, part, last, e.encode(text, start, stop))])
    return run


def _parts(docs: DataFrame, path: str, pat: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """Rows of documents that are one chunk (not encoded yet), and the encoded parts of all others."""
    if overlap <= LOOK or chunk <= overlap:
        raise ValueError("a chunk must be longer than its overlap, and that longer than what a boundary may depend on")
    spark = docs.sparkSession
    rows = text_rows(docs)
    length = F.char_length("text")
    # cut once and written: the names of rows are drawn anew whenever this is computed
    chunks = materialize(rows.where(length > chunk + overlap).mapInArrow(_cut(chunk, overlap), CHUNKS), "chunks", 1)
    total = chunks.agg(F.sum("own")).first()[0]
    n = parts_for(spark, total, PART_CODE_POINTS)
    chunks = chunks.repartition(n, "row", "part")
    while True:
        seams = materialize(_seams(chunks.mapInArrow(release(_seen(path, pat, overlap)), SEEN)), "seams")
        if seams.where("start is null").isEmpty():
            break
        chunks = materialize(_joined(chunks, seams), "chunks", 1)
    following = seams.select("row", F.col("part").alias("next"), F.col("start").alias("more"))
    places = seams.join(following, ["row", "next"], "left").select("row", "part", "start", "more")
    placed = (chunks.join(places, ["row", "part"])
              .select("row", "doc_id", "part", F.col("next").isNull().alias("last"), "text", "start", (F.col("own") + F.coalesce("more", F.lit(0))).alias("stop")))
    return rows.where(length <= chunk + overlap), placed.mapInArrow(release(_encode_spans(path, pat)), ENCODED)


def encode_documents(docs: DataFrame, ranks: str | None = None, pat: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``row, doc_id, part, last, ids`` of every row of ``docs``: ids as little-endian 32-bit numbers.

    A text of at most ``chunk + overlap`` code points is one part (``row`` null);
    the parts of a longer one share a ``row``, are counted upwards with gaps, and
    joined in order are its ids. Null text is empty and has no ids. Rows with a
    null ``doc_id`` or a repeated one are encoded each by itself. Special tokens
    are ordinary text. Extra columns are ignored; an empty table gives no rows.
    """
    path, pat = ranks or tokenizer_path(RANKS), pat or pattern()
    short, long = _parts(docs, path, pat, chunk, overlap)
    return short.mapInArrow(release(_encode_whole(path, pat)), ENCODED).unionByName(long)


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """The rows of ``encode_documents`` with the ``bytes`` of their ids in place of these."""
    path, pat = ranks or tokenizer_path(RANKS), pattern()

    def run(batches):
        e = encoder(path, pat)
        for batch in batches:
            yield _batch(DECODED, list(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "part", "last")),
                                           map(e.decode, batch.column("ids").to_pylist()))))
    return encoded.select("row", "doc_id", "part", "last", "ids").mapInArrow(run, DECODED)


DECODED = "row string, doc_id long, part int, last boolean, bytes binary"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(path: str, pat: str):
    """Checksums per document; the parts of one arrive in order."""
    def run(batches):
        e = encoder(path, pat)
        n, ids, raw = 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            out = []
            for i, last, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "last", "ids"))):
                n += len(packed) // 4
                ids.update(packed)
                raw.update(e.decode(packed))
                if last:
                    out.append((i, n, ids.hexdigest(), raw.hexdigest()))
                    n, ids, raw = 0, hashlib.sha256(), hashlib.sha256()
            yield _batch(DIGEST, out)
    return run


def digest_roundtrip(docs: DataFrame, ranks: str | None = None, pat: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row of ``docs``: number of ids, checksum of the ids, checksum of the bytes decoded from them.

    Documents of one part are done in one pass; the parts of longer ones are
    sorted behind each other and read through once, never held together.
    """
    path, pat = ranks or tokenizer_path(RANKS), pat or pattern()
    short, long = _parts(docs, path, pat, chunk, overlap)
    whole, digest = _encode_whole(path, pat), _digest(path, pat)

    def encode_and_digest(batches):
        yield from digest(whole(batches))
    return (short.mapInArrow(release(encode_and_digest), DIGEST)
            .unionByName(long.repartition("row").sortWithinPartitions("row", "part").mapInArrow(release(digest), DIGEST)))
