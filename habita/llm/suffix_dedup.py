"""Removal of repeated passages by suffix arrays.

A byte goes when a string of ``WIDTH`` bytes that covers it also starts in a
document with a smaller id. Equal strings must meet in one suffix array, and no
array may hold the whole corpus, so text is dealt out by content: every window
of ``WIDTH`` bytes belongs to its anchor, the k-gram with the least hash in it,
and equal windows have equal anchors. First only hashes are exchanged, of each
anchor with some bytes before or after it, to find what different texts share.
The stretches of text around shared anchors then go to the anchor's part; there
a suffix array over all of them is built by induced sorting, and neighbours in
it whose common prefix is long enough form the groups of equal windows, whose
smallest document id is reported back to each slice of documents. Where very
many texts share an anchor, its windows travel one by one, dealt by the window,
so that no part grows with a popular passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import U64, discard, materialize, mix64, parts_for, release, spare_name, text_rows, total_bytes
from .suffix_array import permuted_common, suffix_array
from .tokens import slices

WIDTH = 50
GRAM = 16
SLICE = 3 << 20
PART_BYTES = 32 << 20       # text whose anchor hashes one part of the first exchange holds
ARRAY_BYTES = 6 << 20       # text whose shared stretches one suffix array holds
BUNDLE_KEYS = 1 << 20       # anchor hashes of some slices that a task sends to the parts together
BUNDLE_BYTES = 16 << 20     # different stretches of some slices that a task sends to the parts together: rows grow
BUNDLE_USES = 1 << 19       # with the text times the parts divided by this, not with slices times parts
POPULAR = 2000              # texts that share an anchor, beyond which its windows travel one by one

_ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


_BYTE = mix64(np.arange(256, dtype=U64) + U64(1))
SIDE = (WIDTH - GRAM) // 2      # a window has so many bytes before its anchor, or as many after it
BLOCK = 1 << 17                 # positions hashed at a time


def _window_hashes(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the ``WIDTH`` bytes from each of the positions."""
    out = np.zeros(len(at), U64)
    for k in range(WIDTH):
        out = out * _ODD[0] + _BYTE[b[at + k]]
    return mix64(out)


def anchors(b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of the joined texts ``b`` (text i ends at ``ends[i]``) whose windows share an anchor.

    Returns, per stretch, its text, first and last window, the anchor's place
    and hash, and the hashes of the anchor with ``SIDE`` bytes before it and
    after it (0 where no window of the stretch holds them). A window that begins
    at least ``SIDE`` bytes before its anchor holds the first, any other the
    second; equal windows have equal anchors and the same one of the two.
    """
    none = np.empty(0, np.int64)
    span = WIDTH - GRAM + 1
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else none
    rows: list[tuple] = []
    for start in range(0, len(b) - WIDTH + 1, BLOCK):
        seg = b[start:start + BLOCK + WIDTH - 1]
        h1 = _BYTE[seg]
        h2 = h1[:-1] * _ODD[0] + h1[1:]
        h4 = h2[:-2] * _ODD[1] + h2[2:]
        h8 = h4[:-4] * _ODD[2] + h4[4:]
        h16 = h8[:-8] * _ODD[3] + h8[8:]
        v = (h16 & U64(0xFFFFFFFF00000000)) | np.arange(len(h16), dtype=U64)
        k = 1
        while 2 * k <= span:
            v = np.minimum(v[:-k], v[k:])
            k *= 2
        if k < span:
            v = np.minimum(v[:-(span - k)], v[span - k:])
        # a new stretch where the anchor changes or a text begins
        new = np.ones(len(v), bool)
        new[1:] = v[1:] != v[:-1]
        lo, hi = np.searchsorted(begins, [start, start + len(v)])
        new[begins[lo:hi] - start] = True
        first = np.nonzero(new)[0]
        last = np.concatenate([first[1:], [len(v)]]) - 1
        at = (v[first] & U64(0xFFFFFFFF)).astype(np.int64)
        gram = h16[at]
        # the longer grams: 16 bytes and the SIDE before them, or after them
        left = np.zeros(len(at), U64)
        ok = first <= at - SIDE
        p = at[ok] - SIDE
        left[ok] = mix64(h16[p] * _ODD[4] + h8[p + 16] * _ODD[5] + h8[p + SIDE + GRAM - 8]) | U64(1)
        right = np.zeros(len(at), U64)
        ok = (last > at - SIDE) & (at + GRAM + SIDE <= len(seg))
        p = at[ok]
        right[ok] = mix64(h16[p] * _ODD[5] + h8[p + 16] * _ODD[6] + h8[p + SIDE + GRAM - 8]) | U64(1)
        rows.append((first + start, last + start, at + start, gram, left, right))
    if not rows:
        return none, none, none, none, *[np.empty(0, U64)] * 3
    first, last, at, gram, left, right = (np.concatenate(x) for x in zip(*rows))
    doc = np.searchsorted(begins, first, side="right") - 1
    # texts without bytes begin where the next one does
    last = np.minimum(last, ends[doc] - WIDTH)
    ok = first <= last
    return doc[ok], first[ok], last[ok], at[ok], mix64(gram[ok]), left[ok], right[ok]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each text ends."""
    texts = column.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(data) else np.empty(0, np.uint8)
    return raw, offsets[1:] - offsets[0]


def _part_and_key(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    # the lowest bit of a hash is always set
    return ((h >> U64(1)) % U64(parts)).astype(np.int64), (h >> U64(32)).astype(np.uint32)


GRAMS = "part int, names binary, counts binary, keys binary"


def _anchor_keys(parts: int):
    def packed(keys: list[np.ndarray], docs: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
        """One row for each part, of all texts of a bundle."""
        h, doc, name = np.concatenate(keys), np.concatenate(docs), np.concatenate(names)
        part, key = _part_and_key(h, parts)
        # one sort of part, text and key together; repeats within a text go
        if parts < 1 << 16 and len(name) < 1 << 16:
            both = np.sort(part.astype(U64) << U64(48) | doc.astype(U64) << U64(32) | key)
            both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
            part, key = (both >> U64(48)).astype(np.int64), both.astype(np.uint32)
            owner = name[(both >> U64(32)).astype(np.int64) & 0xFFFF]
        else:
            order = np.lexsort((key, doc, part))
            part, key, owner = part[order], key[order], name[doc[order]]
        rows = []
        cuts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]) if len(part) else [0]
        for x, y in zip(cuts, cuts[1:]):
            begin = np.concatenate([[0], np.nonzero(np.diff(owner[x:y]))[0] + 1])
            count = np.diff(np.concatenate([begin, [y - x]]))
            rows.append((int(part[x]), owner[x:y][begin].astype("<i8").tobytes(), count.astype("<i4").tobytes(), key[x:y].astype("<u4").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
                                          names=["part", "names", "counts", "keys"])

    def run(batches):
        keys, docs, names, held, texts = [], [], [], 0, 0
        for batch in batches:
            for piece in slices(batch, size=SLICE):
                b, ends = _bytes_of(piece.column("text"))
                doc, _, _, _, _, left, right = anchors(b, ends)
                keys += [left[left > 0], right[right > 0]]
                docs += [doc[left > 0] + texts, doc[right > 0] + texts]
                names.append(piece.column("name").to_numpy(zero_copy_only=False))
                held, texts = held + len(keys[-1]) + len(keys[-2]), texts + piece.num_rows
                if held >= BUNDLE_KEYS:
                    yield packed(keys, docs, names)
                    keys, docs, names, held, texts = [], [], [], 0, 0
        if texts:
            yield packed(keys, docs, names)
    return run


def _shared_keys(popular: int, buckets: int):
    def _keys(pdf: pd.DataFrame) -> pd.DataFrame:
        """Anchors of one part that at least two different texts have, per text; popular ones are marked."""
        part = int(pdf["part"].iloc[0])
        count = np.concatenate([np.frombuffer(x, "<i4") for x in pdf["counts"]])
        name = np.repeat(np.concatenate([np.frombuffer(x, "<i8") for x in pdf["names"]]), count)
        key = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["keys"]])
        by = np.argsort(key, kind="stable")
        k = key[by]
        twin = np.zeros(len(k), bool)
        same = k[1:] == k[:-1]
        twin[1:] |= same
        twin[:-1] |= same
        by = by[twin]
        by = by[np.lexsort((name[by], key[by]))]
        key, name = key[by], name[by]
        keep = np.ones(len(key), bool)
        keep[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name = key[keep], name[keep]
        _, back, often = np.unique(key, return_inverse=True, return_counts=True)
        keep = often[back] >= 2 if len(key) else np.empty(0, bool)
        key, name, hot = key[keep], name[keep], (often[back] > popular)[keep] if len(key) else keep
        # part and key in 63 bits, the mark in the lowest
        whole = ((np.int64(part) << 32 | key.astype(np.int64)) << 1) | hot
        to = (mix64(name.view(U64)) % U64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.concatenate([[0], np.nonzero(np.diff(to[order]))[0] + 1, [len(to)]]) if len(to) else [0]
        return pd.DataFrame([(int(to[order[x]]), name[order[x:y]].tobytes(), whole[order[x:y]].tobytes()) for x, y in zip(cuts, cuts[1:])],
                            columns=["bucket", "names", "keys"])
    return _keys


def _keys_by_text(pdf: pd.DataFrame) -> pd.DataFrame:
    """All shared keys of each text of a bucket, sorted."""
    name = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["names"]])
    key = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["keys"]])
    order = np.lexsort((key, name))
    name, key = name[order], key[order]
    cuts = np.concatenate([[0], np.nonzero(np.diff(name))[0] + 1, [len(name)]])
    return pd.DataFrame({"name": name[cuts[:-1]], "keys": [key[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]})


STRETCHES = "uid long, part int, n int, size int, stretches binary, n_uses int, uses binary"


def _squeeze(*arrays: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x if isinstance(x, bytes) else x.tobytes() for x in arrays))


class _Bundle:
    """The different stretches of some slices and who has each where; equal ones stand in it once."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.uses: list[tuple[np.ndarray, ...]] = []        # number of the stretch, part, start, document, name
        self.bytes = self.n_uses = 0

    def add(self, texts: list[bytes], *use: np.ndarray) -> None:
        number, before = self.number, len(self.number)
        which = np.fromiter((number.setdefault(x, len(number)) for x in texts), np.int64, len(texts))
        new, at = np.unique(which, return_index=True)
        self.bytes += sum(len(texts[i]) for i in at[new >= before].tolist())
        self.n_uses += len(texts)
        self.uses.append((which, *use))

    def full(self) -> bool:
        return self.bytes >= BUNDLE_BYTES or self.n_uses >= BUNDLE_USES

    def packed(self, uid: int) -> pa.RecordBatch:
        """One row for each part."""
        which, target, start, ids, name = (np.concatenate(x) for x in zip(*self.uses))
        names, n = list(self.number), len(self.number)
        least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(least, which, ids)
        np.maximum.at(most, which, ids)
        where = np.empty(n, np.int64)
        where[which] = target                   # equal stretches have equal targets
        order, by = np.argsort(where, kind="stable"), np.argsort(target, kind="stable")
        there = np.unique(where)
        cuts, ends = np.append(np.searchsorted(where[order], there), n), np.append(np.searchsorted(target[by], there), len(by))
        local = np.empty(n, np.int64)
        local[order] = np.arange(n) - np.repeat(cuts[:-1], np.diff(cuts))
        rows = []
        for p, x, y, u, v in zip(there.tolist(), cuts.tolist(), cuts[1:].tolist(), ends.tolist(), ends[1:].tolist()):
            mine, occ = order[x:y], by[u:v]
            own = [names[i] for i in mine.tolist()]
            contents = b"".join(own)
            rows.append((uid, p, y - x, len(contents),
                         _squeeze(contents, np.fromiter(map(len, own), "<i2", len(own)), least[mine].astype("<i8"), (most[mine] > least[mine]).astype(np.int8)),
                         v - u, _squeeze(local[which[occ]].astype("<i4"), start[occ].astype("<i8"), ids[occ].astype("<i8"), name[occ].astype("<i8"))))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], names=[c.split()[0] for c in STRETCHES.split(", ")])


def _stretches(parts: int, deal: int):
    """Per bundle of slices and part: the different stretches around shared anchors, and who has each where."""
    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        bundle = _Bundle()
        for batch in batches:
            for piece in slices(batch, size=SLICE):
                b, ends = _bytes_of(piece.column("text"))
                begins = np.concatenate([[0], ends[:-1]])
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
                name = piece.column("name").to_numpy(zero_copy_only=False)
                doc, first, last, place, h, left, right = anchors(b, ends)
                at = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                shared, hot = [], []
                for x in (left, right):
                    part, key = _part_and_key(x, parts)
                    whole = np.where(x > 0, part << 32 | key.astype(np.int64), -1)
                    shared.append(np.zeros(len(doc), bool))
                    hot.append(np.zeros(len(doc), bool))
                    for i, ks in enumerate(piece.column("keys").to_pylist()):
                        mine = np.frombuffer(ks, "<i8")
                        w = whole[at[i]:at[i + 1]]
                        j = np.minimum(np.searchsorted(mine >> 1, w), len(mine) - 1)
                        shared[-1][at[i]:at[i + 1]] = ok = mine[j] >> 1 == w
                        hot[-1][at[i]:at[i + 1]] = ok & (mine[j] & 1 == 1)
                # windows whose own gram is shared: both sides of a stretch together, or either
                turn = place - SIDE
                calm = [x & ~y for x, y in zip(shared, hot)]
                both, lefts, rights = calm[0] & calm[1], calm[0] & ~calm[1], calm[1] & ~calm[0]
                d = np.concatenate([doc[both], doc[lefts], doc[rights]])
                f = np.concatenate([first[both], first[lefts], np.maximum(first, turn + 1)[rights]])
                e = np.concatenate([last[both], np.minimum(last, turn)[lefts], last[rights]])
                to = np.concatenate([h[both], h[lefts], h[rights]])
                ok = f <= e
                d, f, n, to = d[ok], f[ok], (e - f)[ok] + WIDTH, to[ok]
                if hot[0].any() or hot[1].any():
                    hd = np.concatenate([doc[hot[0]], doc[hot[1]]])
                    hf = np.concatenate([first[hot[0]], np.maximum(first, turn + 1)[hot[1]]])
                    many = np.maximum(np.concatenate([np.minimum(last, turn)[hot[0]], last[hot[1]]]) - hf + 1, 0)
                    wd = np.repeat(hd, many)
                    wf = np.repeat(hf, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                    d, f = np.concatenate([d, wd]), np.concatenate([f, wf])
                    n = np.concatenate([n, np.full(len(wd), WIDTH)])
                    to = np.concatenate([to, _window_hashes(b, wf)])
                if not len(d):
                    continue
                bundle.add([b[x:x + m].tobytes() for x, m in zip(f.tolist(), n.tolist())],
                           ((to >> U64(8)) % U64(deal)).astype(np.int64), f - begins[d], ids[d], name[d])
                if bundle.full():
                    yield bundle.packed(uid)
                    uid, bundle = uid + 1, _Bundle()
        if bundle.n_uses:
            yield bundle.packed(uid)
    return run


FOUND = "uid long, part int, owner binary, first binary, last binary, least binary"


def equal_windows(contents: np.ndarray, lengths: np.ndarray, least: np.ndarray, width: int = WIDTH):
    """Smallest document of every window of the stretches: window starts, their stretch, and that smallest id."""
    ends = np.cumsum(lengths)
    # end mark 0, 1 after each stretch, bytes from 2
    t = np.zeros(len(contents) + len(lengths) + 1, np.int32)
    place = np.arange(len(contents)) + np.repeat(np.arange(len(lengths)), lengths)
    t[place] = contents.astype(np.int32) + 2
    t[ends + np.arange(len(lengths))] = 1
    sa = suffix_array(t, 258)
    b = np.full(len(t), 10, np.uint8)
    b[place] = contents
    owner = np.full(len(t), -1, np.int64)
    ok = np.arange(len(contents)) + width <= np.repeat(ends, lengths)
    owner[place[ok]] = np.repeat(np.arange(len(lengths)), lengths)[ok]
    sa = sa[owner[sa] >= 0]
    if not len(sa):
        return sa, sa, sa
    group = np.concatenate([[True], ~permuted_common(b, sa, width)])
    low = np.minimum.reduceat(least[owner[sa]], np.nonzero(group)[0])
    low = np.repeat(low, np.diff(np.concatenate([np.nonzero(group)[0], [len(sa)]])))
    low_at = np.empty(len(t), np.int64)
    low_at[sa] = low
    sa = np.nonzero(owner >= 0)[0]
    low, who = low_at[sa], owner[sa]
    begin = ends - lengths + np.arange(len(lengths))
    return sa - begin[who], who, low


def _may_share(contents: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of the different stretches have an anchor, with the bytes before or after it, that another one has too.

    Equal windows have one of the two in common, so the windows of any other stretch are its own. Different stretches
    of ``WIDTH`` bytes are different windows, so one of those that have it must be longer.
    """
    doc, _, _, _, _, left, right = anchors(contents, np.cumsum(lengths))
    key, doc = np.concatenate([left, right]), np.concatenate([doc, doc])
    key, doc = key[key > 0], doc[key > 0]
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
    at = np.nonzero(first)[0]
    last = np.append(at[1:], len(key)) - 1 if len(at) else at
    shared = (doc[last] != doc[at]) & np.logical_or.reduceat(lengths[doc] > WIDTH, at) if len(at) else first
    out = np.zeros(len(lengths), bool)
    out[doc[np.repeat(shared, last - at + 1)]] = True
    return out


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of one part that some smaller document has, as runs per bundle."""
    counts = pdf["n"].tolist()
    lengths, least, several, contents = [], [], [], []
    unzip = zstandard.ZstdDecompressor()
    for n, size, blob in zip(counts, pdf["size"], pdf["stretches"]):
        raw = unzip.decompress(blob, max_output_size=size + 11 * n)
        contents.append(raw[:size])
        lengths.append(np.frombuffer(raw, "<i2", n, size))
        least.append(np.frombuffer(raw, "<i8", n, size + 2 * n))
        several.append(np.frombuffer(raw, np.int8, n, size + 10 * n))
    lengths, least, several = np.concatenate(lengths).astype(np.int64), np.concatenate(least), np.concatenate(several) == 1
    # equal stretches of different bundles stand in the array once
    number: dict[bytes, int] = {}
    which = np.empty(len(lengths), np.int64)
    i = 0
    for raw, n in zip(contents, counts):
        end = 0
        for m in lengths[i:i + n].tolist():
            which[i] = number.setdefault(raw[end:end + m], len(number))
            end += m
            i += 1
    smallest = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(smallest, which, least)
    joined, sizes = np.frombuffer(b"".join(number), np.uint8), np.fromiter(map(len, number), np.int64, len(number))
    size = sizes - WIDTH + 1
    begin = np.cumsum(size) - size
    who, low = np.repeat(np.arange(len(sizes)), size), np.repeat(smallest, size)
    at = np.arange(len(who)) - begin[who]
    # the others have no window in common with any other stretch
    share = _may_share(joined, sizes)
    if share.any():
        in_at, in_who, in_low = equal_windows(joined[np.repeat(share, sizes)], sizes[share], smallest[share])
        low[begin[share][in_who] + in_at] = in_low
    # windows of each different stretch, for every bundle that has it
    n = size[which]
    pick = np.repeat(begin[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    at, who, low = at[pick], np.repeat(np.arange(len(which)), n), low[pick]
    keep = (low < least[who]) | several[who]
    at, who, low = at[keep], who[keep], low[keep]
    cut = np.concatenate([[True], (np.diff(who) != 0) | (np.diff(low) != 0) | (np.diff(at) != 1)]) if len(at) else np.empty(0, bool)
    begin = np.nonzero(cut)[0]
    last = np.concatenate([begin[1:], [len(at)]]) - 1 if len(begin) else begin
    first_of = np.cumsum([0, *counts])
    row = np.searchsorted(first_of, who[begin], side="right") - 1           # in order, as the stretches are
    there, cuts = np.unique(row, return_index=True)
    uids, parts = pdf["uid"].tolist(), pdf["part"].tolist()
    rows = []
    for r, x, y in zip(there.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(row)]):
        m = begin[x:y], last[x:y]
        rows.append((uids[r], parts[r], (who[m[0]] - first_of[r]).astype("<i4").tobytes(), at[m[0]].astype("<i4").tobytes(),
                     at[m[1]].astype("<i4").tobytes(), low[m[0]].astype("<i8").tobytes()))
    return pd.DataFrame(rows, columns=["uid", "part", "owner", "first", "last", "least"])


def _spans(uses: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
    """Covered byte ranges per document of one bundle, from the runs of its stretches and who has them."""
    unzip = zstandard.ZstdDecompressor()
    have = {p: (n, u) for p, n, u in zip(uses["part"], uses["n_uses"], uses["uses"])}
    docs, names, pairs = [], [], []
    for row in runs.itertuples(index=False):
        owner, first, last = (np.frombuffer(x, "<i4").astype(np.int64) for x in (row.owner, row.first, row.last))
        low = np.frombuffer(row.least, "<i8")
        size, blob = have[row.part]
        raw = unzip.decompress(blob, max_output_size=28 * size)
        has, starts, ids = np.frombuffer(raw, "<i4", size).astype(np.int64), np.frombuffer(raw, "<i8", size, 4 * size), np.frombuffer(raw, "<i8", size, 12 * size)
        names.append(np.frombuffer(raw, "<i8", size, 20 * size))
        lo = np.searchsorted(owner, has, side="left")
        n = np.searchsorted(owner, has, side="right") - lo
        occ = np.repeat(np.arange(len(has)), n)
        run = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        ok = low[run] < ids[occ]
        occ, run = occ[ok], run[ok]
        docs.append(ids[occ])
        names[-1] = names[-1][occ]
        pairs.append(np.stack([starts[occ] + first[run], starts[occ] + last[run] + WIDTH], axis=1))
    doc = np.concatenate(docs) if docs else np.empty(0, np.int64)
    if not len(doc):
        return pd.DataFrame({"doc_id": doc, "name": doc, "spans": []})
    name = np.concatenate(names)
    order = np.lexsort((name, doc))
    doc, name, pair = doc[order], name[order], np.concatenate(pairs)[order]
    cuts = np.concatenate([[0], np.nonzero((np.diff(doc) != 0) | (np.diff(name) != 0))[0] + 1, [len(doc)]])
    return pd.DataFrame({"doc_id": doc[cuts[:-1]], "name": name[cuts[:-1]],
                         "spans": [_merge(pair[x:y]).astype("<i8").tobytes() for x, y in zip(cuts, cuts[1:])]})


def _merge(pairs: np.ndarray) -> np.ndarray:
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    begin = np.nonzero(new)[0]
    return np.stack([pairs[begin, 0], reach[np.concatenate([begin[1:], [len(pairs)]]) - 1]], axis=1)


def _cut(raw: bytes, spans: list | None, copied: bool) -> tuple[bytes, int]:
    if copied:
        return b"", 1
    if not spans:
        return raw, 0
    runs = _merge(np.concatenate([np.frombuffer(s, "<i8").reshape(-1, 2) for s in spans]))
    kept, at = [], 0
    for x, y in runs.tolist():
        kept.append(raw[at:x])
        at = y
    kept.append(raw[at:])
    return b"".join(kept), len(runs)


def find_repeats(docs: DataFrame, popular: int = POPULAR, written: list | None = None) -> DataFrame:
    """``doc_id, name, spans, copied`` of the documents that lose bytes.

    ``name`` is the text's xxhash64 (rows may share a ``doc_id``); ``copied``
    marks an equal text of a smaller id, at least ``WIDTH`` bytes long, which
    goes whole; ``spans`` are covered ranges (pairs of 64-bit integers), several
    lists that may overlap. Rows with a null ``doc_id`` have no order: they
    neither remove nor lose anything. ``written`` collects the tables that the
    result still reads, to be discarded after it.
    """
    spark = docs.sparkSession
    rows = text_rows(docs).where("doc_id is not null").withColumn("name", F.xxhash64("text"))
    size = total_bytes(rows)
    parts, arrays = parts_for(spark, size, PART_BYTES), parts_for(spark, size, ARRAY_BYTES)
    # equal texts first: only the one with the smallest id is searched (128 bits of hash stand for a text)
    sums = rows.select("doc_id", "name", F.xxhash64("text", F.lit(1)).alias("name2"), F.octet_length("text").alias("n"))
    firsts = sums.groupBy("name", "name2", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = (sums.where(F.col("n") >= WIDTH).select("doc_id", "name", "name2")
              .join(firsts.where((F.col("n") >= WIDTH) & (F.col("first") < F.col("last"))).select("name", "name2", "first"), ["name", "name2"])
              .where("doc_id > first").select("doc_id", "name").distinct())
    shared = (rows.select("text", "name").mapInArrow(release(_anchor_keys(parts)), GRAMS)
              .groupBy("part").applyInPandas(release(_shared_keys(popular, parts)), "bucket int, names binary, keys binary")
              .groupBy("bucket").applyInPandas(release(_keys_by_text), "name long, keys binary"))
    wanted = shared.join(firsts.select("name", F.col("first").alias("doc_id")), "name")
    found = materialize(rows.join(wanted, ["doc_id", "name"]).select("doc_id", "name", "text", "keys")
                        .mapInArrow(release(_stretches(parts, arrays)), STRETCHES), "stretches")
    if written is not None:
        written.append(found)
    runs = (found.select("uid", "part", "n", "size", "stretches").repartition(arrays, "part").groupBy("part")
            .applyInPandas(release(_search), FOUND))
    spans = (found.select("uid", "part", "n_uses", "uses").groupBy("uid").cogroup(runs.groupBy("uid"))
             .applyInPandas(_spans, "doc_id long, name long, spans binary").groupBy("doc_id", "name").agg(F.collect_list("spans").alias("spans")))
    return (spans.withColumn("copied", F.lit(False))
            .unionByName(copies.select("doc_id", "name", F.lit(None).cast("array<binary>").alias("spans"), F.lit(True).alias("copied"))))


def _with_marks(docs: DataFrame, popular: int = POPULAR) -> tuple[DataFrame, str, str]:
    """``docs`` with the marks of ``find_repeats`` beside them, and the names of the columns of spans and copies."""
    written: list[DataFrame] = []
    marks = materialize(find_repeats(docs, popular, written), "marks")
    discard(*written)
    own = {c: spare_name(docs, f"mark_{c}") for c in ("id", "name", "spans", "copied")}
    marks = marks.select(*[F.col(c).alias(own[k]) for c, k in (("doc_id", "id"), ("name", "name"), ("spans", "spans"), ("copied", "copied"))])
    marked = docs.join(marks, (F.col("doc_id") == F.col(own["id"])) & (F.xxhash64("text") == F.col(own["name"])), "left")
    return marked.drop(own["id"], own["name"]), own["spans"], own["copied"]


def _digest(batches):
    for batch in batches:
        rows = []
        for text, spans, copied in zip(batch.column("text").cast(pa.large_binary()), batch.column("spans").to_pylist(), batch.column("copied").to_pylist()):
            raw = text.as_py()
            kept, n = _cut(raw, spans, bool(copied))
            rows.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], pa.array([r[3] for r in rows], pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digest_without_repeats(docs: DataFrame, popular: int = POPULAR) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the SHA-256 of what stays.

    Null text is empty; texts under ``WIDTH`` bytes stay whole. Rows that share
    a ``doc_id`` never remove each other's bytes. Extra columns are ignored; an
    empty table gives no rows.
    """
    marked, spans, copied = _with_marks(text_rows(docs), popular)
    return (marked.select("doc_id", "text", F.col(spans).alias("spans"), F.col(copied).alias("copied"))
            .mapInArrow(release(_digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out of ``text``, all other columns as they were, whatever their names.

    Cuts are made in bytes; what is left of a character cut in two is dropped.
    ``n_chars``, if there is one, is counted again; no row goes. A null text
    becomes the empty one. Rows with a null ``doc_id`` stay whole; rows that share
    one never cut each other; an empty table stays empty.
    """
    rows = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    marked, in_spans, in_copied = _with_marks(rows)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            spans, copied = batch.column(in_spans).to_pylist(), batch.column(in_copied).to_pylist()
            texts = [_cut(x.as_py(), s, bool(c))[0].decode("utf-8", "ignore") for x, s, c in zip(batch.column("text").cast(pa.large_binary()), spans, copied)]
            out = batch.select(columns)
            out = out.set_column(out.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            if "n_chars" in columns:
                at = out.schema.get_field_index("n_chars")
                out = out.set_column(at, "n_chars", pa.array([len(t) for t in texts], pa.int64()).cast(out.schema.field(at).type))
            yield out
    return marked.mapInArrow(release(run), docs.schema)
