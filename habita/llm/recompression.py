"""Run-length grammars by recompression, and how far two places of a string agree.

A string is rewritten level by level until every document is one symbol: block
compression replaces a maximal run of one symbol, pair compression replaces the
neighbours ``ab`` with a in the left and b in the right half of the alphabet.
Equal substrings are rewritten alike but for a symbol or so at their ends, so
the common extension of two places is found by climbing while their symbols
agree and descending again at the first that does not: a bounded number of
symbols per level. All documents of a batch share one string; a mark of its own
before each document and after the last keeps matches inside a document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import U64, mix64

BLOCKS, PAIRS = 0, 1


@dataclass
class Level:
    symbols: np.ndarray                 # the string at this level
    step: int | None = None             # how it is rewritten (None: it is the last)
    parent: np.ndarray | None = None    # place of each symbol's parent in the next level
    first: np.ndarray | None = None     # place in this level of the first child of each parent, and the end


def _parents(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.append(np.nonzero(starts)[0], n).astype(np.int32)
    return (np.cumsum(starts, dtype=np.int32) - 1).astype(np.int32), first


def _names(key: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    distinct, name = np.unique(key, return_inverse=True)
    return (name + fresh).astype(np.int32), fresh + len(distinct)


def _blocks(s: np.ndarray, fresh: int):
    """Maximal runs of one symbol become one symbol each; None where there is none."""
    starts = np.ones(len(s), bool)
    starts[1:] = s[1:] != s[:-1]
    if starts.all():
        return None
    parent, first = _parents(starts, len(s))
    size = np.diff(first)
    out = s[first[:-1]].copy()
    long = np.nonzero(size > 1)[0]
    out[long], fresh = _names(out[long].astype(np.int64) << 32 | size[long], fresh)
    return parent, first, out, fresh


def _pairs(s: np.ndarray, marks: int, fresh: int, turn: int):
    """Neighbours from the left and the right half of the alphabet become one symbol; marks stay as they are."""
    half = (mix64(s.astype(U64) + U64((turn + 1) << 32)) >> U64(63)).astype(bool)
    mark = s < marks
    ahead, behind = half & ~mark, ~half & ~mark
    either = ahead[:-1] & behind[1:], behind[:-1] & ahead[1:]
    pair = either[0] if either[0].sum() >= either[1].sum() else either[1]
    starts = np.ones(len(s), bool)
    starts[1:] = ~pair
    parent, first = _parents(starts, len(s))
    out = s[first[:-1]].copy()
    at = np.nonzero(pair)[0]
    out[parent[at]], fresh = _names(s[at].astype(np.int64) << 32 | s[at + 1], fresh)
    return parent, first, out, fresh


def grammar(symbols: np.ndarray, marks: int, names: int) -> list[Level]:
    """Levels of the grammar of ``symbols`` (int32 below ``names``; those below ``marks`` are marks, each occurring once).

    The string starts and ends with a mark. The last level has one symbol
    between marks at most.
    """
    levels = [Level(symbols.astype(np.int32, copy=False))]
    turn = 0
    while len(levels[-1].symbols) > 2 * marks - 1:      # some document has more than one symbol, or an empty one hides it
        now = levels[-1]
        solid = now.symbols >= marks
        if not (solid[1:] & solid[:-1]).any():
            break
        step, made = BLOCKS, _blocks(now.symbols, names)
        if made is None:
            step, made = PAIRS, _pairs(now.symbols, marks, names, turn)
            turn += 1
            if len(made[2]) == len(now.symbols):        # no such pair under this halving
                continue
        now.step, (now.parent, now.first, out, names) = step, made
        levels.append(Level(out))
    return levels


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """Length of the longest common prefix of the suffixes from ``i`` and ``j`` (different places of one document).

    With ``back``: of the longest common suffix of the prefixes that end with them.
    """
    move = -1 if back else 1
    x, y = i.astype(np.int64), j.astype(np.int64)

    def edge(level: Level, parent):
        """The child of each parent that is met first."""
        return level.first[parent + 1] - 1 if back else level.first[parent]

    def left_in_block(level: Level, at, parent):
        """Symbols from ``at`` to the far end of its block."""
        return at - level.first[parent] + 1 if back else level.first[parent + 1] - at
    live = np.arange(len(x))
    stopped: list[np.ndarray] = []
    for level in levels:
        same = level.symbols[x[live]] == level.symbols[y[live]]
        out, live = [live[~same]], live[same]
        if level.parent is not None and len(live):
            u, v = x[live], y[live]
            p, q = level.parent[u], level.parent[v]
            inside = (u != edge(level, p)) | (v != edge(level, q))      # one of them is amid its parent
            if inside.any():
                within, u, v, p, q = live[inside], u[inside], v[inside], p[inside], q[inside]
                if level.step == BLOCKS:
                    a, b = left_in_block(level, u, p), left_in_block(level, v, q)
                    n = np.minimum(a, b)
                    uneven = a != b                                      # the longer block goes on where the other has ended
                else:
                    n, uneven = 1, None
                x[within] = u + move * n
                y[within] = v + move * n
                if uneven is not None and uneven.any():
                    out.append(within[uneven])
                    gone = np.zeros(len(x), bool)
                    gone[within[uneven]] = True
                    live = live[~gone[live]]
            x[live], y[live] = level.parent[x[live]], level.parent[y[live]]
        stopped.append(np.concatenate(out))
    down = np.empty(0, np.int64)
    for depth in range(len(levels) - 1, 0, -1):
        down = np.concatenate([down, stopped[depth]])
        if not len(down):
            continue
        level = levels[depth - 1]
        p, q = x[down], y[down]
        u, v = edge(level, p).astype(np.int64), edge(level, q).astype(np.int64)
        same = level.symbols[u] == level.symbols[v]
        if level.step == BLOCKS:
            n = np.minimum(level.first[p + 1] - level.first[p], level.first[q + 1] - level.first[q])
            u, v = u + move * n * same, v + move * n * same
        else:
            u, v = u + move * same, v + move * same
        x[down], y[down] = u, v
    return (x - i) * move
