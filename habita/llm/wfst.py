"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled from a model file: the normaliser (its own rewrite rules and white
space, see ``normaliser``), the pieces with their scores, and bytes for
characters without a piece. Composed with a text they give a lattice: places of
the normalised text are states, an arc reads a piece and weighs minus its score
(a character without a piece ten more than the worst). In the tropical semiring
the shortest path through it is the segmentation of a unigram model; weights are
added in 32 bits as the library does, so that it chooses alike among near ties.

A merge-built (BPE) vocabulary does not choose pieces by adding up scores; its
segmentation is the one in which every two neighbours are what merging gives for
their own joined text. That is a condition on pairs, so a bigram acceptor
(weight 0 where a pair may stand together, infinite where not, worked out when
first met) is composed as well, and states remember the last piece. Exactly one
path of the composition has finite weight, so the first complete one that a
depth-first search meets is the shortest (``tropical_path`` relaxes all states
and gives the same; the tests compare them). No path crosses a place whose two
characters stand next to each other in no piece, so texts are cut into words,
and words at such places, and composed part by part; a worker remembers the
paths of words and parts seen (a bounded number).

Word and character models, user-defined pieces, models without byte fallback and
with a denormaliser are rejected.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_rows
from .normaliser import MARK, Normaliser, rewrite_rules
from .tokens import slices, tokenizer_path

MODEL = "piece_bpe_32k.model"
CACHED_WORDS, CACHED_PARTS = 800_000, 600_000
SLICE = 3 << 20


def _fields(raw: bytes):
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value, shift = 0, 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, raw[at:at + size]
        at += size


UNIGRAM, BPE = 1, 2             # fixed values: model types, and types of pieces
NORMAL, UNUSED, BYTE, USER_DEFINED = 1, 5, 6, 4
PENALTY = np.float32(10)        # fixed value: of a character without a piece, below the worst score


class Transducer:
    """Normaliser, pieces, byte fallback and pair acceptor of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto()
        message: dict[int, list] = {}
        for k, v in _fields(model):
            message.setdefault(k, []).append(v)
        trainer, normal, denormal = (dict(_fields(message[k][-1])) if k in message else {} for k in (2, 3, 5))
        self.type = trainer.get(3, UNIGRAM)
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge-built (BPE) models are supported")
        if not trainer.get(35) or trainer.get(24):
            raise ValueError("only models with byte fallback and marks before words are supported")
        if denormal.get(2) or not normal.get(5, 1):
            raise ValueError("this normaliser is not supported")
        self.id_of: dict[str, int] = {}
        self.score: dict[str, np.float32] = {}
        self.byte_id = [0] * 256
        self.bytes_of: list[bytes] = []
        for i, raw in enumerate(message.get(1, [])):
            fields = dict(_fields(raw))
            piece, kind = fields[1].decode(), fields.get(3, NORMAL)
            score = np.frombuffer(fields.get(2, bytes(4)), "<f4")[0]
            if kind == USER_DEFINED:
                raise ValueError("user-defined pieces are not supported")
            if kind == BYTE:
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif kind == NORMAL:
                self.id_of[piece] = i
                self.score[piece] = score
                self.bytes_of.append(piece.encode())
            else:
                self.bytes_of.append(b"")
        self.worst = min(self.score.values(), default=np.float32(0)) - PENALTY
        self.normalise = Normaliser(rewrite_rules(normal.get(2, b"")), bool(normal.get(3, 1)), bool(normal.get(4, 1)))
        if self.type == BPE and any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id_of):
            raise ValueError("a piece continues past the end of a word")
        self.begins = {p[:k] for p in self.id_of for k in range(1, len(p) + 1)}
        known = {c for p in self.id_of for c in p}
        # words end before a mark; line feed and tab, in no piece, stand alone
        alone = "".join(c for c in "\n\t" if c not in known)
        cut = re.escape(alone)
        self.words = re.compile(f"[{cut}]|{MARK}*[^{MARK}{cut}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.neighbours = {p[k:k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self.together: dict[tuple[str, str], bool] = {}
        self.kind = np.dtype("<u2" if len(self.bytes_of) <= 1 << 16 else "<u4")
        self.of_word: dict[str, bytes] = {}
        self.of_part: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """What merging gives for a short text: best score first, leftmost among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def accepts(self, left: str, right: str) -> bool:
        """Weight of the pair acceptor: whether the two may be neighbours."""
        ok = self.together.get((left, right))
        if ok is None:
            if len(self.together) > 2_000_000:
                self.together = {}
            ok = self.together[left, right] = self.merged(left + right) == [left, right]
        return ok

    def _arcs(self, word: str, i: int) -> list[str]:
        """Arcs of the lattice that leave state ``i``, shortest first; one character without a piece is read as bytes."""
        out = [word[i]]
        for j in range(i + 2, len(word) + 1):
            arc = word[i:j]
            if arc not in self.begins:
                break
            if arc in self.id_of:
                out.append(arc)
        return out

    def tropical_path(self, text: str) -> list[int]:
        """Ids along the path of least weight through the lattice of a normalised text.

        States are places (with the last arc where pairs are restricted); every
        state is relaxed from the left, the first of equal weights stays.
        """
        pairs = self.type == BPE
        best: list[dict] = [{} for _ in range(len(text) + 1)]       # per place: context -> weight, place and context before, arc
        best[0][""] = (np.float32(0), 0, "", "")
        for i in range(len(text)):
            if not best[i]:
                continue
            for arc in self._arcs(text, i):
                weight = np.float32(0) if pairs else -self.score.get(arc, self.worst)
                there, context = best[i + len(arc)], arc if pairs else ""
                for last, (before, *_) in best[i].items():
                    if pairs and last and not self.accepts(last, arc):
                        continue
                    total, old = before + weight, there.get(context)
                    if old is None or total < old[0]:
                        there[context] = (total, i, last, arc)
        at, path = len(text), []
        context = min(best[at], key=lambda c: best[at][c][0])
        while at:
            _, at, context, arc = best[at][context]
            path.append(arc)
        return self._ids(path[::-1])

    def _ids(self, path: list[str]) -> list[int]:
        ids: list[int] = []
        for arc in path:
            ids += [self.id_of[arc]] if arc in self.id_of else [self.byte_id[b] for b in arc.encode()]
        return ids

    def only_path(self, word: str) -> list[int]:
        """Ids along the one path of finite weight through a merge-built lattice, depth first and longest arc first."""
        n, together = len(word), self.together
        # a state that leads nowhere is not entered twice
        path: list[str] = []
        open_arcs, at, dead = [self._arcs(word, 0)], 0, set()
        while at < n:
            arcs = open_arcs[-1]
            while arcs:
                arc = arcs.pop()
                if path:
                    ok = together.get((path[-1], arc))
                    if not (self.accepts(path[-1], arc) if ok is None else ok):
                        continue
                if (at + len(arc), arc) not in dead:
                    path.append(arc)
                    at += len(arc)
                    open_arcs.append(self._arcs(word, at) if at < n else [])
                    break
            else:
                if not path:
                    raise ValueError(f"no path through {word!r}")
                open_arcs.pop()
                dead.add((at, path[-1]))
                at -= len(path.pop())
        return self._ids(path)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text (none for the empty text)."""
        text = self.normalise(text)
        if not text:
            return np.empty(0, np.uint32)
        if self.type == UNIGRAM:
            return np.array(self.tropical_path(text), np.uint32)
        words = self.words(text)
        if len(self.of_word) > CACHED_WORDS:
            self.of_word = {}
        of_word = self.of_word
        for w in words:
            if w not in of_word:
                of_word[w] = self._ids_of_word(w)
        return np.frombuffer(b"".join([of_word[w] for w in words]), self.kind).astype(np.uint32)

    def _ids_of_word(self, word: str) -> bytes:
        if len(self.of_part) > CACHED_PARTS:
            self.of_part = {}
        out, start, end = [], 0, len(word)
        for k in range(1, end + 1):
            if k == end or word[k - 1:k + 1] not in self.neighbours:
                part = word[start:k]
                ids = self.of_part.get(part)
                if ids is None:
                    ids = self.of_part[part] = np.array(self.only_path(part), self.kind).tobytes()
                out.append(ids)
                start = k
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces and bytes joined, marks to spaces, the first mark dropped."""
        text = b"".join([self.bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer per Python worker and file."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def _encode_all(path: str):
    def run(batches):
        for batch in batches:
            for part in slices(batch, size=SLICE):
                t = transducer(path)
                n, crc, sha, same = [], [], [], []
                for text in part.column("text").to_pylist():
                    ids = t.encode(text)
                    back = t.decode(ids)
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    sha.append(hashlib.sha256(back.encode()).hexdigest())
                    same.append(back == text.replace(MARK, " "))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())],
                                                 names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"])
    return run


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: number and crc32 (little-endian unsigned 32-bit) of its ids, the SHA-256 of the
    decoded text, and whether that is the text (the word mark itself reads as a space; a normaliser
    that rewrites makes it another one).

    Null text is empty and has no ids. Rows with a null or repeated ``doc_id``
    each get a row; extra columns are ignored; an empty table gives no rows.
    """
    path = model or tokenizer_path(MODEL)
    return text_rows(docs).mapInArrow(_encode_all(path), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
