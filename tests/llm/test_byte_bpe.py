import hashlib
import random

import numpy as np
import pytest

from habita.llm import byte_bpe, queries
from habita.session import read_table

from ..conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=byte_bpe.pattern(), mergeable_ranks=byte_bpe.read_ranks(byte_bpe.tokenizer_path(byte_bpe.RANKS)), special_tokens={})


def digest(library, i, text):
    ids = library.encode_ordinary(text or "")
    return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def key(row):
    return tuple((x is None, x) for x in row)


def odd_texts(seed, n):
    """Text full of seams that are hard to find: contractions, white space, long runs, every script, unassigned code points."""
    rnd = random.Random(seed)
    parts = ["'s", "'re", "'", "''", " ", "  ", "\n", "\t ", "a", "it's", " I'LL", "12", " 3", "...", " !?", "é", "日本語", "\U0001F600", "́", "\x1c",
             "՘", "Ᲊ", "Ɤ", "\U00010d40", "<|endoftext|>", " " * 40, "x" * 90, "7" * 45, "-" * 70, " the quick brown fox"]
    for _ in range(n):
        yield "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 3, 40, 400])))


def test_merging_equals_the_library(library):
    ranks = byte_bpe.read_ranks(byte_bpe.tokenizer_path(byte_bpe.RANKS))
    rnd = random.Random(4)
    for _ in range(3000):
        piece = bytes(rnd.choice(b"abcdeaaathein\xc3\xa9\xff  ") for _ in range(rnd.randrange(1, 60)))
        assert byte_bpe.merge(piece, ranks) == library._encode_single_piece(piece)
    long = ("ab" * 3000 + "aaa" * 4001).encode()
    assert byte_bpe.merge(long, ranks) == library._encode_single_piece(long)


@pytest.mark.parametrize("chunk, overlap", [(40, 12), (64, 30), (1000, 100)])
def test_chunks_are_stitched_exactly(spark, library, chunk, overlap):
    texts = list(odd_texts(chunk, 60))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = byte_bpe.digest_roundtrip(docs, chunk=chunk, overlap=overlap).collect()
    assert sorted(map(tuple, got)) == [digest(library, i, t) for i, t in enumerate(texts)]
    parts = byte_bpe.encode_documents(docs, chunk=chunk, overlap=overlap)
    raw = byte_bpe.decode_documents(parts).orderBy("doc_id", "part").collect()
    joined = {}
    for r in raw:
        joined[r["doc_id"]] = joined.get(r["doc_id"], b"") + bytes(r["bytes"])
    assert [joined[i].decode() for i in range(len(texts))] == texts and len(raw) > len(texts)


def test_a_run_longer_than_many_chunks(spark, library):
    texts = ["a" * 5000 + " b", " " * 5000 + "b", "x y " * 30 + "q" * 3000 + " z" * 400, "'" * 1500 + "s" * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = byte_bpe.digest_roundtrip(docs, chunk=100, overlap=20).collect()
    assert sorted(map(tuple, got)) == [digest(library, i, t) for i, t in enumerate(texts)]


def test_every_code_point_is_classed_as_in_the_library(library):
    every = "".join(chr(c) + ("" if c % 3 else "a") for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    e = byte_bpe.encoder(byte_bpe.tokenizer_path(byte_bpe.RANKS), byte_bpe.pattern())
    for at in range(0, len(every), 100_000):
        part = every[at:at + 100_000]
        packed = e.encode(part)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(part)
        assert e.decode(packed) == part.encode()


def test_odd_rows(odd_docs, no_docs, library):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = byte_bpe.digest_roundtrip(odd_docs).collect()
    assert sorted(map(tuple, got), key=key) == sorted((digest(library, i, t) for i, t in rows), key=key)
    assert byte_bpe.digest_roundtrip(no_docs).collect() == [] and byte_bpe.encode_documents(no_docs).collect() == []


def test_query_equals_the_library(spark, library):
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = queries.op11_byte_bpe(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(digest(library, i, t) for i, t in rows)


def test_chunks_must_be_longer_than_overlaps(odd_docs):
    with pytest.raises(ValueError):
        byte_bpe.encode_documents(odd_docs, chunk=100, overlap=100)
