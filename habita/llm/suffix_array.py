"""Suffix arrays by induced sorting, whole buckets at a time.

Suffixes are classed as smaller (S) or larger (L) than the one after them. The
substrings between leftmost S suffixes are sorted by one induction, named, and
the string of names, without what names that occur once decide, is sorted by
recursion; a second induction from the sorted
leftmost S suffixes gives the array. An induction visits buckets in order and
moves a bucket's waiting suffixes together: the predecessors that fall into the
same bucket form its next wave. Where buckets are small - the names of a recursion
are many - suffixes are induced one by one instead, in the same order.
"""

from __future__ import annotations

from array import array

import numpy as np

SMALL = 32          # suffixes per bucket on average, below which they are induced one by one


def classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last (the end mark) is."""
    up = np.ones(len(t), bool)
    up[:-1] = t[1:] > t[:-1]
    # within a run of one symbol the step after the run decides
    runs = np.nonzero(np.append(t[1:] != t[:-1], True))[0]
    return np.repeat(up[runs], np.diff(np.concatenate([[-1], runs])))


def _place(sa: np.ndarray, edge: np.ndarray, items: np.ndarray, symbols: np.ndarray, sign: int) -> None:
    """Put items into their buckets in order, from the front (+1) or the back (-1)."""
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    first = np.concatenate([[0], np.nonzero(np.diff(s))[0] + 1])
    count = np.diff(np.concatenate([first, [len(s)]]))
    rank = np.arange(len(s)) - np.repeat(first, count)
    at = edge[s] + rank if sign > 0 else edge[s] - 1 - rank
    sa[at] = items[order]
    edge[s[first]] += sign * count


def induce(t: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array induced from the order of the leftmost S suffixes."""
    n = len(t)
    if symbols * SMALL > n:
        return _induce_singly(t, smaller, leftmost, symbols)
    size = np.bincount(t, minlength=symbols)
    end = np.cumsum(size)
    start = end - size
    sa = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    # leftmost S suffixes wait at the ends of their buckets while L suffixes are induced
    seeds = leftmost[np.argsort(t[leftmost], kind="stable")]
    seed_end = np.cumsum(np.bincount(t[leftmost], minlength=symbols))
    head = start.copy()
    large = ~smaller
    for c in range(symbols):
        if not size[c]:
            continue
        done = start[c]
        while True:
            wave = sa[done:head[c]]
            if not len(wave):
                break
            done = head[c]
            j = wave[wave > 0] - 1
            j = j[large[j]]
            if len(j):
                _place(sa, head, j, t[j], 1)
        j = seeds[(seed_end[c - 1] if c else 0):seed_end[c]]
        j = j[j > 0] - 1
        if len(j):
            _place(sa, head, j, t[j], 1)
    tail = end.copy()
    for c in range(symbols - 1, -1, -1):
        if not size[c]:
            continue
        done = end[c]
        if c == t[n - 1] and size[c] == 1:      # the end mark stands alone in its bucket
            sa[start[c]] = n - 1
            tail[c] = start[c]
        while True:
            wave = sa[tail[c]:done][::-1]
            if not len(wave):
                break
            done = tail[c]
            j = wave[wave > 0] - 1
            j = j[smaller[j]]
            if len(j):
                _place(sa, tail, j, t[j], -1)
        j = sa[start[c]:head[c]][::-1]
        j = j[j > 0] - 1
        j = j[smaller[j]]
        if len(j):
            _place(sa, tail, j, t[j], -1)
    return sa


def _induce_singly(t: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """The same for buckets of few suffixes."""
    n = len(t)
    end = np.cumsum(np.bincount(t, minlength=symbols))
    sa = np.full(n, -1, np.int64)
    seeds = leftmost[np.argsort(t[leftmost], kind="stable")]
    several = np.bincount(t[leftmost], minlength=symbols)
    nth = np.arange(len(seeds)) - np.repeat(np.cumsum(several) - several, several)
    sa[(end - several)[t[seeds]] + nth] = seeds             # at the ends of their buckets, in order
    # bucket of the suffix before each one if that is L (or S), else -1; the place -1 stands for nothing
    before = np.concatenate([[-1], t[:-1].astype(np.int64), [-1]])
    is_large = np.concatenate([[False], ~smaller[:-1], [False]])
    to_head, to_tail, sa = (array("q", x.tobytes()) for x in (np.where(is_large, before, -1), np.where(is_large, -1, before), sa))
    head = np.concatenate([[0], end[:-1]]).tolist()
    for i in sa:                        # the list is filled ahead of the loop
        c = to_head[i]
        if c >= 0:
            at = head[c]
            sa[at] = i - 1
            head[c] = at + 1
    tail = end.tolist()
    for i in reversed(sa):
        c = to_tail[i]
        if c >= 0:
            tail[c] = at = tail[c] - 1
            sa[at] = i - 1
    return np.frombuffer(sa, np.int64).astype(np.int32 if n < 1 << 31 else np.int64)


def _order_of_names(reduced: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by recursion on what the names alone do not decide.

    A name that occurs once ends every comparison. So of each run of such names
    the first is kept, behind the repeated names that it ends, and the shorter
    string sorts its suffixes like the whole one.
    """
    count = np.bincount(reduced)
    once = count[reduced] == 1
    keep = ~once
    keep[1:] |= ~once[:-1]
    keep[-1] = True                     # the end mark's name, the smallest
    kept = np.nonzero(keep)[0]
    distinct, short = np.unique(reduced[kept], return_inverse=True)
    repeated = kept[suffix_array(short, len(distinct))]
    repeated = repeated[~once[repeated]]            # in order, hence by name
    start = np.cumsum(count) - count
    out = np.empty(len(reduced), np.int64)
    out[start[reduced[once]]] = np.nonzero(once)[0]
    name = reduced[repeated]
    first = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.empty(0, bool)
    at = np.nonzero(first)[0]
    nth = np.arange(len(name)) - np.repeat(at, np.diff(np.append(at, len(name))))
    out[start[name] + nth] = repeated
    return out


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``t``, whose last symbol is smallest and occurs once."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    t = t.astype(np.uint16 if symbols <= 1 << 16 else np.int64, copy=False)      # short symbols are sorted by radix
    smaller = classify(t)
    is_left = smaller.copy()
    is_left[0] = False
    is_left[1:] &= ~smaller[:-1]
    leftmost = np.nonzero(is_left)[0]
    if len(leftmost) < 2:
        return induce(t, smaller, leftmost, symbols)
    by_substring = induce(t, smaller, leftmost, symbols)
    order = by_substring[is_left[by_substring]]
    # equal substrings get equal names
    nth = np.full(n, -1, np.int64)
    nth[leftmost] = np.arange(len(leftmost))
    length = np.diff(np.concatenate([leftmost, [n]]))[nth[order]]
    same = length[1:] == length[:-1]
    pairs = np.nonzero(same)[0]
    k = 0
    while len(pairs):
        inside = k <= length[pairs]                 # the next substring's first symbol belongs to this one
        a, b = order[pairs] + k, order[pairs + 1] + k
        ok = ~inside | ((a < n) & (b < n) & (t[np.minimum(a, n - 1)] == t[np.minimum(b, n - 1)]))
        same[pairs[~ok]] = False
        pairs = pairs[ok & inside]
        k += 1
    name = np.concatenate([[0], np.cumsum(~same)])
    reduced = np.empty(len(leftmost), np.int64)
    reduced[nth[order]] = name
    if name[-1] + 1 == len(leftmost):
        return induce(t, smaller, order, symbols)
    return induce(t, smaller, leftmost[_order_of_names(reduced)], symbols)


def permuted_common(t: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each position of ``order`` but the first, in text order of positions: whether it and its
    predecessor in the array share ``length`` bytes (each has so many left); returned in array order."""
    before_of = np.full(len(t), -1, np.int64)
    before_of[order[1:]] = order[:-1]
    here = np.nonzero(before_of >= 0)[0]                    # text order
    before = before_of[here]
    equal = np.ones(len(here), bool)
    live = np.arange(len(here))
    if length < 8:
        for k in range(length):
            equal &= t[np.minimum(here + k, len(t) - 1)] == t[np.minimum(before + k, len(t) - 1)]
    else:
        padded = np.concatenate([t, np.zeros(8, np.uint8)])
        word = np.ndarray((len(t),), np.uint64, padded, 0, (1,))        # the eight bytes from each position
        for at in [*range(0, length - 8, 8), length - 8]:
            ok = word[here[live] + at] == word[before[live] + at]
            equal[live[~ok]] = False
            live = live[ok]
    flag = np.zeros(len(t), bool)
    flag[here] = equal
    return flag[order[1:]]
