"""Token ids of whole texts with a public tokenizer file, word by word.

The tokenizer drops white space, never joins characters across it and always
cuts between a letter and closing punctuation, so a text's ids are the ids of
its parts in order. Each batch is split and its distinct parts found in Arrow;
the tokenizer sees a part once per worker (a bounded number is remembered).
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
SLICE_BYTES = 8 << 20
BATCH_ROWS = 4000        # documents per Arrow batch: a larger batch repeats more words
CACHED_WORDS = 600_000
CUT = r"([A-Za-z])([.,;:!?*#$%&])"     # between these the tokenizer always cuts
# parts in which nothing composes with the character before it: lower-casing their ASCII letters first changes no ids, unless an added token begins
CASELESS = r"\A[\x00-\x7F\x{A0}-\x{24F}\x{2010}-\x{201F}]*\z"
PLAIN = re.compile("[a-z]+").fullmatch


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _spread(values: np.ndarray, begin: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[begin[i]:begin[i] + size[i]]`` for every i of ``at``, joined; and the end of each."""
    n = size[at]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begin[at] - (ends - n), n) + np.arange(total)], ends


def _ends_of_lists(lists: pa.Array, item_ends: np.ndarray) -> np.ndarray:
    """End of each list's joined items, given the end of each item."""
    items = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    return np.concatenate([[0], item_ends])[items].astype(np.int64)


def _lower(parts: pa.Array) -> pa.Array:
    """ASCII letters of the parts that allow it in lower case."""
    odd = pc.invert(pc.string_is_ascii(parts))
    at = np.nonzero(odd.to_numpy(zero_copy_only=False))[0]
    if len(at):
        safe = pc.match_substring_regex(parts.take(pa.array(at)), CASELESS).to_numpy(zero_copy_only=False)
        at = at[~safe]
    added = np.nonzero(pc.match_substring(parts, "<|").to_numpy(zero_copy_only=False))[0]
    keep = np.union1d(at, added)
    low = pc.ascii_lower(parts)
    if not len(keep):
        return low
    mask = np.zeros(len(parts), bool)
    mask[keep] = True
    return pc.replace_with_mask(low, pa.array(mask), parts.take(pa.array(keep)))


class WordEncoder:
    """Encodes batches of texts; keeps the ids of parts of words seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        self.slot: dict[str, int] = {}
        self.flat, self.begin, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, parts: list[str]) -> None:
        ids: list[list[int]] = [None] * len(parts)
        other = []
        tokenize = self.tokenizer.model.tokenize
        for i, p in enumerate(parts):
            if PLAIN(p):
                ids[i] = [t.id for t in tokenize(p)]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch([parts[i] for i in other], add_special_tokens=False)):
            ids[i] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for p in ids for x in p), np.uint32, int(size.sum()))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])
        n = len(self.slot)
        self.slot.update((p, n + i) for i, p in enumerate(parts))

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and the offset of each (one more than texts)."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = pc.list_flatten(lists).dictionary_encode()
        parts_of = pc.ascii_split_whitespace(pc.replace_substring_regex(words.dictionary, CUT, r"\1 \2"))
        raw = pc.list_flatten(parts_of)
        parts = _lower(raw).dictionary_encode()
        if len(self.slot) > CACHED_WORDS:
            self._forget()
        names = parts.dictionary.to_pylist()
        new = [p for p in names if p not in self.slot]
        if new:
            self._learn(new)
        slot = np.fromiter(map(self.slot.__getitem__, names), np.int64, len(names))
        at = parts.indices.to_numpy(zero_copy_only=False)
        flat, ends = _spread(self.flat, self.begin, self.size, slot[at])
        word_end = _ends_of_lists(parts_of, ends)
        size = np.diff(np.concatenate([[0], word_end]))
        ids, ends = _spread(flat, word_end - size, size, words.indices.to_numpy(zero_copy_only=False))
        offsets = np.concatenate([[0], _ends_of_lists(lists, ends)]).astype(np.int64)
        if end_id is None:
            return ids, offsets
        return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES):
    """Consecutive parts of a batch of about ``size`` bytes of text, more only where one text is longer."""
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(length) // size
    cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
