"""N-gram Jaccard join by parity sketches.

A document is its set of word shingles. A sketch has a number of words (lanes)
fixed by the size band; each shingle is XORed into one lane, so two sketches
differ in at most as many lanes as the sets have shingles not in common - their
Hamming distance is a lower bound of the symmetric difference. A likeness of at
least T allows (1 - T) / (1 + T) of both sizes together to differ, so by the
pigeonhole principle two linked documents agree in some non-empty lane as soon
as one of them has more non-empty lanes than that (a document with fewer also
uses one lane per shingle). Each document is looked up by its rarest lanes only,
one more than may differ: whatever order lanes have, as long as all documents
use the same, a linked pair shares one of those. What shares a lane is compared
by one-bit-per-shingle parity sketches and then verified on the full sets.

Documents with equal sets are one class from the start. In the first round a
class is paired with the smallest class of each lane. The classes paired with
one smallest class are a group that holds every other pair of those lanes; a
group whose classes end up in different components is gone through again in
blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import U64, discard, materialize, mix64, parts_for, release, shingle_hashes, text_rows, total_bytes
from .components import connected_components
from .tokens import slices

NUMERATOR, DENOMINATOR = 75, 100
SKETCH_BITS = 512
LANES = 0.4             # lanes per shingle of the largest set of a size band
LEAST_LANES = 64
PART_BYTES = 10 << 20   # text whose lanes one part of the exchange holds
SLICE = 3 << 20
TURNS = 2               # further classes that the rest of a group is tried against
BLOCK = 1024            # classes per block when a lane is gone through again


def band_of(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def lanes_of(band: np.ndarray) -> np.ndarray:
    return np.maximum(np.ceil(LANES * 2.0 ** (band + 1)), LEAST_LANES).astype(np.int64)


def most_different(n: np.ndarray, nexts: np.ndarray) -> np.ndarray:
    """Shingles not in common that a linked pair may have, this set being in its own or the next band's sketch."""
    largest = n * DENOMINATOR // NUMERATOR
    own = np.minimum(largest, 2 ** (band_of(n) + 1) - 1)
    other = np.where(nexts, largest, own)
    return (n + other) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def class_ids(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One 64-bit name per set; equal sets have equal names (empty set: 0)."""
    sums = np.concatenate([[U64(0)], np.cumsum(mix64(h), dtype=U64)])
    other = np.concatenate([[U64(0)], np.cumsum(mix64(h ^ U64(0xA5A5A5A5A5A5A5A5)), dtype=U64)])
    n = np.diff(off)
    out = mix64((sums[off[1:]] - sums[off[:-1]]) ^ mix64(other[off[1:]] - other[off[:-1]]) + n.astype(U64))
    return np.where(n > 0, out, U64(0)).view(np.int64)


def parity_sketches(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One bit flipped per shingle, ``SKETCH_BITS`` bits, as bytes; one row per set."""
    n = len(off) - 1
    bit = (mix64(h + U64(77)) >> U64(32)).astype(np.int64) % SKETCH_BITS
    doc = np.repeat(np.arange(n), np.diff(off))
    odd = np.bincount(doc * SKETCH_BITS + bit, minlength=n * SKETCH_BITS) & 1
    return np.packbits(odd.reshape(n, SKETCH_BITS).astype(np.uint8), axis=1)


def lane_entries(h: np.ndarray, off: np.ndarray):
    """(owner set, use, key) of every non-empty lane, and (owner, use, filled, differ) of every use.

    Uses: 0 own band, 1 next band, 2 and 3 the same with one lane per shingle.
    """
    n = np.diff(off)
    keys, owners, uses, groups = [], [], [], []
    doc = np.repeat(np.arange(len(n)), n)
    for use in (0, 1):
        wanted = n > 0
        if use:
            wanted &= n * DENOMINATOR // NUMERATOR >= 2 ** (band_of(n) + 1)
        if not wanted.any():
            continue
        band = band_of(n) + use
        lanes = lanes_of(band)
        differ = most_different(n, np.full(len(n), bool(use)))
        pick = wanted[doc]
        d, x = doc[pick], h[pick]
        lane = ((mix64(x + band[d].astype(U64)) >> U64(32)) * lanes[d].astype(U64) >> U64(32)).astype(np.int64)
        order = np.lexsort((lane, d))
        d, lane, x = d[order], lane[order], x[order]
        begin = np.concatenate([[0], np.nonzero((np.diff(d) != 0) | (np.diff(lane) != 0))[0] + 1]).astype(np.int64)
        words = np.bitwise_xor.reduceat(x, begin)
        d, lane = d[begin], lane[begin]
        filled = np.bincount(d, minlength=len(n))
        enough = filled > differ
        ok = enough[d]
        keys.append(mix64(words[ok] ^ mix64((band[d[ok]] << 40 | lane[ok]).astype(U64))))
        owners.append(d[ok])
        uses.append(np.full(int(ok.sum()), use, np.int8))
        groups.append((np.nonzero(wanted)[0], np.full(int(wanted.sum()), use), filled[wanted], differ[wanted]))
        short = wanted & ~enough
        # every document in doubt also stands in the finer sketch, so that two of them meet there
        if short.any():
            pick = short[doc]
            keys.append(mix64(h[pick] ^ mix64((band[doc[pick]] << 40 | (1 << 39)).astype(U64))))
            owners.append(doc[pick])
            uses.append(np.full(int(pick.sum()), use + 2, np.int8))
            groups.append((np.nonzero(short)[0], np.full(int(short.sum()), use + 2), n[short], differ[short]))
            # and still in the coarse one, for partners that are not in doubt
            ok = short[d]
            keys.append(mix64(words[ok] ^ mix64((band[d[ok]] << 40 | lane[ok]).astype(U64))))
            owners.append(d[ok])
            uses.append(np.full(int(ok.sum()), use, np.int8))
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)      # noqa: E731
    table = [cat([g[i] for g in groups], np.int64) for i in range(4)]
    return cat(keys, U64), cat(owners, np.int64), cat(uses, np.int8), table


# a row of documents: names, whether an id is missing, sizes, ids, hashes of the texts without one, sketches
SKETCHED = "kind int, part int, names binary, uses binary, filled binary, differ binary, counts binary, keys binary"


def _sketch(parts: int):
    """Per slice of documents: one row of documents with class, size and parity sketch, one row of lane keys per part."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, size=SLICE):
                h, off = shingle_hashes(piece.column("text"))
                n = np.diff(off)
                name = class_ids(h, off)
                doc = piece.column("doc_id")
                null = doc.is_null().to_numpy(zero_copy_only=False)
                sketch = parity_sketches(h, off)
                rows = [(0, -1, name.tobytes(), null.astype(np.int8).tobytes(), n.astype("<i8").tobytes(),
                         doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                         piece.column("text_hash").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), sketch.tobytes())]
                # each class once in a slice
                _, first = np.unique(name, return_index=True)
                first = np.sort(first[n[first] > 0])
                sub_off = np.concatenate([[0], np.cumsum(n[first])])
                at = np.repeat(off[first] - sub_off[:-1], n[first]) + np.arange(sub_off[-1])
                key, owner, use, (g_owner, g_use, g_filled, g_differ) = lane_entries(h[at], sub_off)
                info = np.zeros((2, len(first), 4), np.int64)
                info[0, g_owner, g_use], info[1, g_owner, g_use] = g_filled, g_differ
                part = (key % U64(parts)).astype(np.int64)
                low = (key >> U64(32)).astype(np.uint32)
                group = owner * 4 + use
                order = np.lexsort((group, part))
                part, low, group = part[order], low[order], group[order]
                cuts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]) if len(part) else [0]
                for a, b in zip(cuts, cuts[1:]):
                    g, count = np.unique(group[a:b], return_counts=True)
                    rows.append((1, int(part[a]), name[first[g // 4]].tobytes(), (g % 4).astype(np.int8).tobytes(),
                                 info[0, g // 4, g % 4].astype("<i4").tobytes(), info[1, g // 4, g % 4].astype("<i4").tobytes(),
                                 count.astype("<i4").tobytes(), low[a:b].astype("<u4").tobytes()))
                kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(8)],
                                                 names=[c.split()[0] for c in SKETCHED.split(", ")])
    return run


def _documents(batches):
    for pdf in batches:
        for name, null, n, doc, text_hash, sketch in zip(pdf["names"], pdf["uses"], pdf["filled"], pdf["differ"], pdf["counts"], pdf["keys"]):
            gone = np.frombuffer(null, np.int8) == 1
            size = np.frombuffer(n, "<i8")
            width = SKETCH_BITS // 8
            yield pd.DataFrame({"doc_id": pd.arrays.IntegerArray(np.frombuffer(doc, "<i8").copy(), gone), "name": np.frombuffer(name, "<i8"),
                                "n_shingles": size, "text_hash": np.frombuffer(text_hash, "<i8"), "sketch": [sketch[i * width:(i + 1) * width] for i in range(len(size))]})


SHARED = "bucket int, names binary, uses binary, filled binary, differ binary, keys binary, often binary"


def _shared_keys(buckets: int):
    """Keys of one part that at least two classes have, with the number of classes, packed by bucket of class."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        count = np.concatenate([np.frombuffer(x, "<i4") for x in pdf["counts"]])
        key = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["keys"]])
        info = [np.concatenate([np.frombuffer(x, k) for x in pdf[c]]) for c, k in (("names", "<i8"), ("uses", np.int8), ("filled", "<i4"), ("differ", "<i4"))]
        # keys that stand in one entry only are no use to anyone
        by = np.argsort(key, kind="stable")
        twin = np.zeros(len(key), bool)
        same = key[by][1:] == key[by][:-1]
        twin[1:] |= same
        twin[:-1] |= same
        by = by[twin]
        key, group = key[by], np.repeat(np.arange(len(count), dtype=np.int32), count)[by]
        name, use, filled, differ = (x[group] for x in info)
        order = np.lexsort((use, name, key))
        key, name, use, filled, differ = (x[order] for x in (key, name, use, filled, differ))
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new_name = new_key.copy()
        new_name[1:] |= name[1:] != name[:-1]
        new_entry = new_name.copy()
        new_entry[1:] |= use[1:] != use[:-1]
        nth = np.cumsum(new_key) - 1
        often = np.bincount(nth, new_name).astype(np.int32)[nth] if len(key) else np.empty(0, np.int32)
        keep = new_entry & (often >= 2)
        key, name, use, filled, differ, often = (x[keep] for x in (key, name, use, filled, differ, often))
        whole = key.astype(np.int64) | (part << 32)
        to = (mix64(name.view(U64)) % U64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.concatenate([[0], np.nonzero(np.diff(to[order]))[0] + 1, [len(to)]]) if len(to) else [0]
        rows = []
        for x, y in zip(cuts, cuts[1:]):
            o = order[x:y]
            rows.append((int(to[o[0]]), name[o].tobytes(), use[o].tobytes(), filled[o].tobytes(), differ[o].tobytes(), whole[o].tobytes(), often[o].tobytes()))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SHARED.split(", ")])
    return run


def _rarest(pdf: pd.DataFrame) -> pd.DataFrame:
    """The keys each class of a bucket is looked up by: of its lanes the rarest, one more than may differ."""
    name, use, filled, differ, key, often = (np.concatenate([np.frombuffer(x, k) for x in pdf[c]]) for c, k in (
        ("names", "<i8"), ("uses", np.int8), ("filled", "<i4"), ("differ", "<i4"), ("keys", "<i8"), ("often", "<i4")))
    order = np.lexsort((key, often, use, name))
    name, use, filled, differ, key = (x[order] for x in (name, use, filled, differ, key))
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (use[1:] != use[:-1])
    begin = np.nonzero(new)[0]
    size = np.diff(np.concatenate([begin, [len(name)]]))
    rank = np.arange(len(name)) - np.repeat(begin, size)
    keep = rank < differ + 1 - (filled - np.repeat(size, size))      # lanes not shared with anyone are the rarest
    return pd.DataFrame({"key": key[keep], "name": name[keep]})


def _hash_sets(batches):
    for batch in batches:
        for part in slices(batch, size=SLICE):
            h, off = shingle_hashes(part.column("text"))
            own = pa.array(class_ids(h, off) == part.column("name").to_numpy(zero_copy_only=False))     # a doc_id may stand for several texts
            yield pa.RecordBatch.from_arrays([part.column("name"), pa.array([h[a:b].astype("<u8").tobytes() for a, b in zip(off, off[1:])], pa.binary())],
                                             names=["name", "hashes"]).filter(own)


def _verify(batches):
    for pdf in batches:
        ok = []
        for x, y in zip(pdf["ha"], pdf["hb"]):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            ok.append(DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common))
        yield pdf.loc[ok, ["a", "b"]]


def _near(size_a, size_b, distance):
    """Sizes and parity sketches allow a link."""
    return ((DENOMINATOR * np.minimum(size_a, size_b) >= NUMERATOR * np.maximum(size_a, size_b))
            & ((DENOMINATOR + NUMERATOR) * distance <= (DENOMINATOR - NUMERATOR) * (size_a + size_b)))


def _near_pairs(batches):
    for pdf in batches:
        if len(pdf):
            a = np.frombuffer(b"".join(pdf["sketch_a"]), "<u8").reshape(len(pdf), -1)
            b = np.frombuffer(b"".join(pdf["sketch_b"]), "<u8").reshape(len(pdf), -1)
            distance = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            yield pdf.loc[_near(pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy(), distance), ["a", "b"]]


def _open_pairs(batches):
    """Pairs of classes of the same group (rows arrive sorted by group) that sizes, sketches and components leave open.

    A row's group is a block of classes, or two blocks (then only pairs across count).
    """
    def pairs(f):
        group = f.groupby(["key", "i", "j"], sort=False).ngroup().to_numpy()
        name, n, component, block, key = (f[c].to_numpy() for c in ("name", "n_shingles", "component", "block", "key"))
        inside = [frozenset(k.tolist()) for k in f["keys"]]
        alone = (f["i"] == f["j"]).to_numpy()
        words = np.frombuffer(b"".join(f["sketch"]), "<u8").reshape(len(f), -1)
        a, b, live, d = [], [], np.arange(len(f)), 1
        while True:
            live = live[live + d < len(f)]
            live = live[group[live + d] == group[live]]
            if not len(live):
                break
            x, y = live, live + d
            ok = (component[x] != component[y]) & (alone[x] | (block[x] != block[y])) & _near(n[x], n[y], 0)
            x, y = x[ok], y[ok]
            ok = _near(n[x], n[y], np.bitwise_count(words[x] ^ words[y]).sum(axis=1, dtype=np.int64))
            x, y = x[ok], y[ok]
            # a pair that meets in several groups counts in the one with the smallest key
            ok = np.fromiter((min(inside[i] & inside[j]) == key[i] for i, j in zip(x.tolist(), y.tolist())), bool, len(x))
            a.append(np.minimum(name[x[ok]], name[y[ok]]))
            b.append(np.maximum(name[x[ok]], name[y[ok]]))
            d += 1
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates() if a else pd.DataFrame({"a": [], "b": []}, dtype="int64")
    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        last = held.iloc[-1] if len(held) else None
        if last is not None:
            tail = ((held["key"] == last["key"]) & (held["i"] == last["i"]) & (held["j"] == last["j"])).to_numpy()
            if not tail.all():
                yield pairs(held[~tail])
                held = held[tail].reset_index(drop=True)
    if held is not None and len(held):
        yield pairs(held)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return (pairs.join(sets.select(F.col("name").alias("a"), F.col("hashes").alias("ha")), "a")
            .join(sets.select(F.col("name").alias("b"), F.col("hashes").alias("hb")), "b")
            .select("a", "b", "ha", "hb").mapInPandas(release(_verify), "a long, b long"))


def link_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Linked: 100 * common >= 75 * all shingles of both. ``component_id`` is the
    smallest ``doc_id`` reachable by links. Null text is empty; a document
    without words is its own component. Rows with a null ``doc_id`` link like
    any other and take the smallest known id, or null. Rows sharing a
    ``doc_id`` are compared each by its own text. Extra columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = text_rows(docs)
    parts = parts_for(spark, total_bytes(rows), PART_BYTES)
    hashed = rows.withColumn("text_hash", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    sketched = materialize(hashed.mapInArrow(release(_sketch(parts)), SKETCHED), "lanes")
    documents = materialize(sketched.where("kind = 0").select("names", "uses", "filled", "differ", "counts", "keys").mapInPandas(
        release(_documents), "doc_id long, name long, n_shingles long, text_hash long, sketch binary"), "documents")
    entries = materialize(sketched.where("kind = 1").groupBy("part").applyInPandas(release(_shared_keys(parts)), SHARED)
                          .groupBy("bucket").applyInPandas(release(_rarest), "key long, name long"), "entries")
    discard(sketched)
    # a lane's smallest class stands for it: (key, name) now says that name shares a lane with that class
    hubs = entries.groupBy("key").agg(F.min("name").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    groups = materialize(entries.join(hubs, "key").select(F.col("hub").alias("key"), "name").distinct(), "groups")
    discard(entries)
    known = materialize(documents.select("name", "n_shingles", "sketch").join(groups.select("name").distinct(), "name", "left_semi")
                        .groupBy("name").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    side = lambda x: known.select(F.col("name").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))     # noqa: E731

    def plausible(pairs, tag):
        return materialize(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
                           .mapInPandas(release(_near_pairs), "a long, b long"), tag)
    pairs = plausible(groups.where("name <> key").select(F.col("key").alias("a"), F.col("name").alias("b")), "pairs")
    # the document that stands for a class; a class that only rows without an id have is found by a hash of its text
    one = documents.groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.min(F.when(F.col("doc_id").isNull(), F.col("text_hash"))).alias("text_hash"))
    nameless = rows.where("doc_id is null").select(F.xxhash64("text").alias("text_hash"), "text")

    def verified(pairs, tag):
        """Full shingle sets of the classes in question, from one document each; then every pair."""
        names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        wanted = one.join(names, "name")
        texts = (rows.join(wanted.where("doc_id is not null"), "doc_id").select("name", "text")
                 .unionByName(nameless.join(wanted.where("doc_id is null").select("name", "text_hash"), "text_hash").select("name", "text").dropDuplicates(["name"])))
        sets = materialize(texts.mapInArrow(release(_hash_sets), "name long, hashes binary"), "sets")
        found = materialize(_verified(pairs, sets), tag)
        discard(sets)
        return found
    links = verified(pairs, "links")
    cc = connected_components(links)

    def place(cc):
        return (groups.join(cc.withColumnRenamed("node", "name"), "name", "left")
                .select("key", "name", F.coalesce("component", "name").alias("component")))
    # the classes around one smallest class hold every other pair that shares one of its lanes; what is
    # not connected to it is tried against a few more classes of the group ...
    for turn in range(TURNS):
        placed = place(cc)
        hubs = placed.groupBy("key").agg(F.min_by(F.struct("name", "component"), F.xxhash64("name", F.lit(turn))).alias("h"))
        tried = (placed.join(hubs, "key").where("component <> h.component")
                 .select(F.least("name", "h.name").alias("a"), F.greatest("name", "h.name").alias("b")).distinct()
                 .join(pairs, ["a", "b"], "left_anti"))
        tried = plausible(tried, "pairs")
        if tried.isEmpty():
            break
        pairs, links = pairs.unionByName(tried), links.unionByName(verified(tried, "links"))
        cc = connected_components(links)
    # ... and where a group is in several components still, go through it again, block against block
    placed = place(cc)
    split = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
             .where("lo <> hi and n > 2").select("key", "n"))
    memberships = groups.groupBy("name").agg(F.collect_list("key").alias("keys"))       # at most one per lane of the class
    again = (placed.join(split, "key").join(known, "name").join(memberships, "name")
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "name", "component", "n_shingles", "sketch", "keys"))
    more = materialize(again.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                       .mapInPandas(release(_open_pairs), "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more, "links"))
        cc = connected_components(links)
    least = (documents.where("n_shingles > 0").groupBy("name").agg(F.min("doc_id").alias("least"))
             .join(cc, F.col("name") == F.col("node"), "left").select("name", "least", F.coalesce("component", "name").alias("component")))
    lowest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = least.join(lowest, "component").select("name", "component_id")
    return (documents.select("doc_id", "n_shingles", "name").join(classes, "name", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
