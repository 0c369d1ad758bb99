import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from habita.llm import huffman, packing, wfst
from habita.llm.tokens import WordEncoder, slices, tokenizer_path

ODD = ["", " ", "a<|endoftext|>b c", "<|endoftext|>.x a<|endoftext|>, <|startoftext|>!b", "é ́x Σας ΣΑΣ\x0bq\x1cz\x85y k\u2003l",
       "it's 12 '' 's don't don.t x's.'re 5.3 é.É! \u0301. e\u0301. ñ;", "\tX\n\nİ", "日本語 \U0001F600!!", "a" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_tokenizers_ids(tokenizer):
    rnd = random.Random(4)
    alphabet = list("abcdeABC  \n\t.,;:!?'\"-0123éüßσΣ日\u0301\u00a0<|>")
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    for part in (pa.array(texts), pa.array(["skip"] + texts).slice(1)):
        ids, off = WordEncoder(tokenizer_path()).encode(part, 1)
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_case_before_the_tokenizers_own_rules(tokenizer):
    """Added tokens are matched on raw text, and marks compose before letters are lower-cased."""
    texts = ["<|ENDOFTEXT|>", "a<|EndOfText|>B", "<|STARTOFTEXT|>.<|endoftext|>X", "H\u0331", "xT\u0308y", "W\u030a", "J\u030c.", "h\u0331 t\u0308", "ÀÉ’S Réaction’s ŁÓDŹ", "\u212a \u2126 Å\u0301", "A\u00a0B\x85C",
             "<\u0338", "IT'S O'RE\u0301"]
    marks = "".join(map(chr, [*range(0x300, 0x345), 0x338, 0x1161, 0x11a8]))
    texts += [c + m for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ<=>" for m in marks]
    texts += [a + chr(c) for a in "AHJTW" for c in [*range(0xa0, 0x250), *range(0x2010, 0x2020)]]
    ids, off = WordEncoder(tokenizer_path()).encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (1, 50, 3, 0, 200, 7, 7)])], names=["text"])
    parts = [p.column("text").to_pylist() for p in slices(batch, size=60)]
    assert sum(parts, []) == batch.column("text").to_pylist() and len(parts) > 1


def test_code_lengths_are_best_and_limited():
    import heapq
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 300):
        counts = np.zeros(n + 5, np.int64)
        counts[5:] = rnd.integers(1, 1000, n)
        lengths = huffman.code_lengths(counts, 20)
        assert (lengths[counts == 0] == 0).all() and (lengths[counts > 0] > 0).all()
        heap = counts[counts > 0].tolist()
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            x = heapq.heappop(heap) + heapq.heappop(heap)
            cost += x
            heapq.heappush(heap, x)
        assert n == 1 or (counts * lengths).sum() == cost
    skewed = np.array([1 << min(k, 60) for k in range(64)])
    lengths = huffman.code_lengths(skewed, 8)
    assert lengths.max() <= 8 and abs(sum(2.0 ** -lengths.astype(float)) - 1) < 1e-9


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 20000])
def test_block_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = np.minimum(rnd.geometric(0.01, n), 3000)
    ids = np.concatenate([ids, np.arange(3001)])[:max(n, 0)] if n < 5000 else np.concatenate([ids[:n - 3001], np.arange(3001)])
    lengths = huffman.code_lengths(np.bincount(np.concatenate([ids, np.arange(3001)])))
    codes, table = huffman.canonical(lengths)
    payload, marks = huffman.encode(ids, lengths, codes)
    assert len(payload) == (int(lengths[ids].sum()) + 7) // 8
    if n:
        assert (huffman.decode(payload, n, marks, table) == ids).all()
        # from any checkpoint on, without what comes before
        rest = huffman.decode(payload, n - (len(marks) - 1) * huffman.STEP, marks[-1:], table)
        assert (rest == ids[(len(marks) - 1) * huffman.STEP:]).all()


def known(docs):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -2 ** 63, r["text"] or "") for r in docs.collect()))


def test_id_files(odd_docs, tokenizer, tmp_path):
    huffman.write_ids(odd_docs, str(tmp_path / "ids"))
    got = [tuple(r) for r in huffman.read_ids(odd_docs.sparkSession, str(tmp_path / "ids")).collect()]
    want = [(i, tokenizer.encode(t, add_special_tokens=False).ids + [1]) for i, t in known(odd_docs)]
    assert sorted((-2 ** 63 if g[0] is None else g[0], g[2], g[3]) for g in got) == sorted((i, len(x), crc(x)) for i, x in want)
    got.sort(key=lambda g: g[1])
    assert [g[0] for g in got] == [None if i == -2 ** 63 else i for i, _ in want]
    assert [g[1] for g in got] == [sum(g[2] for g in got[:k]) for k in range(len(got))]


def test_id_files_of_an_empty_table(no_docs):
    assert huffman.roundtrip(no_docs).collect() == []


def test_pieces_fill_sequences(odd_docs, tokenizer):
    got = packing.pack_documents(odd_docs).collect()
    want = {(i, t): tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in known(odd_docs) if i != -2 ** 63}
    ids = {i: x for (i, _), x in want.items()}
    for r in got:
        assert 1 <= r["length"] <= 2048 and r["start"] == 2048 * r["piece"]
        if r["doc_id"] is not None:
            assert crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) == r["ids_crc32"]
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in known(odd_docs))
    assert sum(r["length"] for r in got) == total
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by.values():
        end = 0
        for at, n in sorted(rows):
            assert at == end
            end += n
        assert end <= 2048


def test_packing_an_empty_table(no_docs):
    assert packing.pack_documents(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_valid_and_close_to_the_bound(seed):
    rnd = np.random.default_rng(seed)
    h = np.zeros(2049, np.int64)
    lengths = [rnd.integers(1, 2049, 4000), rnd.geometric(0.004, 5000), np.full(999, 1500), rnd.integers(900, 1100, 3000), np.full(10, 2048), rnd.integers(1, 20, 50000)][seed]
    np.add.at(h, np.minimum(lengths, 2048), 1)
    p = packing.plan(h)
    placed, ends = {}, {}
    for v, rank, n, seq, at in zip(*(p[k].tolist() for k in ("length", "rank", "count", "sequence", "offset"))):
        for k in range(n):
            assert placed.setdefault((v, rank + k), seq + k) == seq + k
            ends.setdefault(seq + k, []).append((at, v))
    assert len(placed) == h.sum() == p["count"].sum()
    for rows in ends.values():
        end = 0
        for at, v in sorted(rows):
            assert at == end
            end += v
        assert end <= 2048
    bound = max(-(-int((h * np.arange(2049)).sum()) // 2048), int(h[1025:].sum()))
    assert len(ends) <= 1.03 * bound + 2


def test_nnls_against_definition():
    rnd = np.random.default_rng(3)
    a, y = np.abs(rnd.normal(size=(12, 30))), rnd.normal(size=12)
    x = packing.nnls(a, y)
    slope = a.T @ (y - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_pieces_equal_the_library():
    import sentencepiece
    path = tokenizer_path(wfst.MODEL)
    sp, t = sentencepiece.SentencePieceProcessor(model_file=path), wfst.Transducer(path)
    rnd = random.Random(8)
    alphabet = list("abcdefghij klmnop  \n\t.,;:!?'\"-0123456789éüß日本語\U0001F600\u0301\u00a0\u200bАБВгде▁<>s/")
    texts = ODD + ["  Hello   world\n\nfoo\tbar ", "▁▁x ▁", "aaaaaaaaaaaaaaaaaaaaaaaa"] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for x in texts:
        ids = t.encode(x)
        assert ids.tolist() == sp.encode(x), x
        assert t.decode(ids) == x.replace("▁", " ") == sp.decode(ids.tolist()).replace("▁", " ") or "▁" in x, x


def piece_model(path, kind, pieces, rules="identity", tidy=False, front=True, fallback=True, extra=()):
    """A model file put together by hand (nothing is trained): pieces with scores, bytes, and a stock normaliser."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto
    stock = sentencepiece.SentencePieceNormalizer(rule_name=rules, add_dummy_prefix=front, remove_extra_whitespaces=tidy)
    m = proto.ModelProto.FromString(stock.serialized_model_proto())
    del m.pieces[:]
    for name, type_ in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=name, score=0, type=type_)
    for b in range(256 if fallback else 0):
        m.pieces.add(piece="<0x%02X>" % b, score=0, type=6)
    for piece, score in pieces:
        m.pieces.add(piece=piece, score=score, type=1)
    for piece, type_ in extra:
        m.pieces.add(piece=piece, score=0, type=type_)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = kind, fallback
    m.trainer_spec.unk_id, m.trainer_spec.bos_id, m.trainer_spec.eos_id = 0, 1, 2
    with open(path, "wb") as f:
        f.write(m.SerializeToString())
    return str(path)


MIXED = ["  Hello   world ", "the theme there", "ﬁne ﬁsh Ａｂｃ １２", "naïve é ñ", "日本語 \U0001F600 x", "tab\there\nline", "", "   ", "▁mark", "　wide　space　"]


def mixed_texts(seed):
    rnd = random.Random(seed)
    alphabet = list("abcdethri   \n\tﬁＡé１.̈日▁") + ["the", " the", "re"]
    return MIXED + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 80))) for _ in range(600)]


@pytest.mark.parametrize("rules, tidy, front", [("identity", False, True), ("nmt_nfkc", True, True), ("nfkc_cf", True, False), ("nfkc", False, False)])
def test_unigram_models_equal_the_library(tmp_path, rules, tidy, front):
    """Pieces by score: shortest paths with ties, unknown characters and every stock normaliser."""
    import sentencepiece
    rnd = random.Random(3)
    marks = ["▁" + x for x in ("t", "th", "the", "there", "h", "a", "ab", "abc", "")]
    pieces = {p: -rnd.choice([1.0, 2.0, 2.5, 3.25, 7.1, 9.9]) for p in marks + list("abcdethri.123") + ["he", "re", "er", "the", "there", "bc", "cd", "ab", "é", "fi", "fin", "t▁h"]}
    path = piece_model(tmp_path / "m.model", 1, pieces.items(), rules, tidy, front)
    sp, t = sentencepiece.SentencePieceProcessor(model_file=path), wfst.Transducer(path)
    for x in mixed_texts(1) + ["abcdethri the there " * 400]:
        assert t.encode(x).tolist() == sp.encode(x), x


@pytest.mark.parametrize("rules, tidy", [("identity", False), ("nmt_nfkc", True)])
def test_merge_built_models_with_a_normaliser_equal_the_library(tmp_path, rules, tidy):
    import sentencepiece
    merges = ["th", "he", "the", "re", "▁t", "▁th", "▁the", "er", "ere", "ab", "bc", "abc", "cd", "▁▁", "fi", "in", "11"]
    pieces = [(m, -float(k)) for k, m in enumerate(merges)] + [(c, -100.0 - k) for k, c in enumerate("▁abcdethrifn1é.")]
    path = piece_model(tmp_path / "m.model", 2, pieces, rules, tidy)
    sp, t = sentencepiece.SentencePieceProcessor(model_file=path), wfst.Transducer(path)
    for x in mixed_texts(2):
        assert t.encode(x).tolist() == sp.encode(x), x


def test_relaxing_all_states_gives_the_only_path():
    t, rnd = wfst.Transducer(tokenizer_path(wfst.MODEL)), random.Random(6)
    words = ["▁" + "".join(rnd.choice("abcdefghinorstue") for _ in range(rnd.randrange(1, 14))) for _ in range(300)] + ["▁internationalisation", "日本語", "▁x\u0301y"]
    for w in words:
        assert t.tropical_path(w) == t.only_path(w), w


def test_normalisers_equal_the_library():
    import sentencepiece
    from habita.llm.normaliser import Normaliser, rewrite_rules
    for rules in ("nmt_nfkc", "nfkc_cf", "identity"):
        for tidy in (True, False):
            stock = sentencepiece.SentencePieceNormalizer(rule_name=rules, add_dummy_prefix=True, remove_extra_whitespaces=tidy)
            spec = [dict(wfst._fields(v)) for k, v in wfst._fields(stock.serialized_model_proto()) if k == 3][0]
            own = Normaliser(rewrite_rules(spec.get(2, b"")), True, tidy)
            for x in mixed_texts(4) + ["각 한 \u1100\u1161\u11a8 ① ㌀ ͅ ſ İ"]:
                assert own(x) == stock.Normalize(x), (rules, x)


def test_other_models_are_rejected(tmp_path):
    pieces = [("a", -1.0), ("▁", -2.0)]
    for kind, fallback, extra in ((3, True, ()), (4, True, ()), (1, False, ()), (2, True, (("own", 4),))):
        with pytest.raises(ValueError, match="supported"):
            wfst.Transducer(piece_model(tmp_path / "m.model", kind, pieces, fallback=fallback, extra=extra))


def test_transducer_query(odd_docs, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(wfst.MODEL))
    got = wfst.encode_documents(odd_docs).collect()
    assert all(r["round_trip"] for r in got)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -2 ** 63, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (i, len(sp.encode(t)), crc(sp.encode(t))) for i, t in known(odd_docs))
    assert wfst.encode_documents(no_docs).collect() == []
