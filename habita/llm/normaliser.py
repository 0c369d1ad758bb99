"""The normaliser of a SentencePiece model, compiled from its own rules into a transducer.

Rules rewrite a string by another; of the rules that match at a place the
longest is taken, a character without a rule passes. Around them stand the
model's treatment of white space: a mark in front, runs of spaces as one, none
at the ends, spaces written as the mark. The machine has one bit of state
(whether the last output was a space) and one path per input.
"""

from __future__ import annotations

import numpy as np

MARK = "▁"


def rewrite_rules(compiled: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie over UTF-8 bytes, whose values point into a pool of strings.

    Fixed format: the trie's size in bytes (4, little-endian), its 32-bit units,
    the pool of zero-ended strings. Of a unit, bit 8 says that a rule ends here,
    bits 0-7 (and 31) are the label, the rest is the offset to the children.
    """
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units, pool = np.frombuffer(compiled[4:4 + size], "<u4").astype(np.int64), compiled[4 + size:]

    def offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)
    rules: dict[str, str] = {}
    labels = np.arange(1, 256)
    frontier = [(int(offset(units[0])), b"")]
    while frontier:                                 # level by level: as many as the longest rule has bytes
        at = np.array([p for p, _ in frontier])
        place = at[:, None] ^ labels[None, :]
        unit = units[np.minimum(place, len(units) - 1)]
        row, col = np.nonzero((place < len(units)) & (unit & 0x800000FF == labels[None, :]))
        following = []
        for r, c in zip(row.tolist(), col.tolist()):
            u = int(unit[r, c])
            child, key = int(place[r, c]) ^ int(offset(u)), frontier[r][1] + bytes([c + 1])
            if u >> 8 & 1:
                start = int(units[child]) & 0x7FFFFFFF
                rules[key.decode()] = pool[start:pool.index(0, start)].decode()
            following.append((child, key))
        frontier = following
    return rules


class Normaliser:
    """``rules`` and the three white-space settings of a model."""

    def __init__(self, rules: dict[str, str], front_mark: bool = True, tidy: bool = True, escape: bool = True):
        self.rules, self.front_mark, self.tidy, self.space = rules, front_mark, tidy, MARK if escape else " "
        self.begins = {k[:n] for k in rules for n in range(1, len(k))}
        self.plain = not rules and not tidy

    def arcs(self, text: str):
        """Output of each arc along the path of a text: the longest rule at each place, or the character itself."""
        at, size, rules, begins = 0, len(text), self.rules, self.begins
        while at < size:
            end, out = at + 1, text[at]
            if out in rules or out in begins:
                k = at + 1
                while True:
                    key = text[at:k]
                    if key in rules:
                        end, out = k, rules[key]
                    if k >= size or key not in begins:
                        break
                    k += 1
            yield out
            at = end

    def __call__(self, text: str) -> str:
        if not text:
            return ""
        if self.plain:
            return (self.space if self.front_mark else "") + text.replace(" ", self.space)
        out: list[str] = []
        after_space = self.tidy             # spaces at the start go as those after a space do
        for piece in self.arcs(text):
            if after_space:
                piece = piece.lstrip(" ")
            if piece:
                out.append(piece.replace(" ", self.space))
                after_space = self.tidy and piece.endswith(" ")
        whole = "".join(out)
        if self.tidy:
            while whole.endswith(self.space):
                whole = whole[:-len(self.space)]
        if not whole:
            return ""
        return (self.space if self.front_mark else "") + whole
