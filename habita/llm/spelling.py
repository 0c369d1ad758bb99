"""Spelling variants: words one edit apart, found by a frontier that walks a trie relation level by level.

The trie of the vocabulary is a table with one row per node (a prefix) and its
edges. A state (word, position, node, edits) says that the word's first
``position`` code points lead to ``node`` with so many edits. Each round joins
the frontier with the nodes of one depth: without an edit yet, a state follows
the edge of its next code point, and at every other edge, and once for skipping
its own code point, leaves the path with one edit; with one edit it only
follows. A state that has used its whole word and one edit at the end of a word
has found a neighbour. An edit is made only where word and path first differ.
Words stand in the trie in both directions and are edited in their second half
only, as near the root every edit leads on for several levels; a state is made
only if the letter it needs next goes on from its node.

Words longer than ``LONGEST`` would need as many rounds: they meet instead under
the hashes of what is left when one code point is taken out, counted in
groups, not in pairs (words that agree but for one code point at the same place
are all neighbours of each other).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, materialize

LETTERS = r"[A-Za-zÀ-ÿ]+"     # fixed value: what a word is made of
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROPS = 199             # a run whose checksum this divides loses one code point
LEAST_LENGTH = 6        # code points of a word
LEAST_COUNT = 5         # occurrences of a word
TIMES = 5               # so many times a word's occurrences its form has at least
LONGEST = 48            # code points of words that walk the trie
SMALL_TABLE = 100_000   # nodes of one depth up to which they are sent to all executors


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n``: occurrences of every run of letters in all texts, A-Z lower-cased, misprints planted by checksum.

    A run whose ``crc32("<doc_id>:<run>")`` ``DROPS`` divides loses the code
    point at checksum % length. A null text has no runs; a null ``doc_id`` is
    written as the empty string. Counts are summed per task before the shuffle,
    so a word that makes up a third of all text reaches its reducer as one row
    per task.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    # within ASCII, lower-casing is just that of A-Z
    runs = runs.select("id", F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = (h % F.char_length("run")).cast("int")
    word = F.when(h % DROPS == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.char_length("run")))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n")))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""
    return count_words(docs).where((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


FORWARD, BACKWARD = ">", "<"


def spellings(words: DataFrame) -> DataFrame:
    """``spelled, n``: every word behind the mark of reading forward, and reversed behind that of reading backward."""
    return (words.select("n", F.explode(F.array(F.concat(F.lit(FORWARD), "word"), F.concat(F.lit(BACKWARD), F.reverse("word")))).alias("spelled"))
            .select("spelled", "n"))


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(letter), F.lit(64)))


def trie(spelled: DataFrame) -> DataFrame:
    """``depth, node, edges``: for every inner node (a prefix, mark included) its edges.

    An edge has its letter ``ch``, ``n`` of the word that ends there (or null), and
    ``nexts``, a bit for each letter (mod 64) that goes on from there.
    """
    steps = spelled.select("spelled", "n", F.explode(F.sequence(F.lit(1), F.greatest(F.char_length("spelled") - 1, F.lit(1)))).alias("depth"))
    edges = (steps.select("depth", F.substring("spelled", F.lit(1), F.col("depth")).alias("node"), F.substring("spelled", F.col("depth") + 1, F.lit(1)).alias("ch"),
                          F.when(F.col("depth") + 1 == F.char_length("spelled"), F.col("n")).alias("n"),
                          F.when(F.col("depth") + 1 < F.char_length("spelled"), _bit(F.substring("spelled", F.col("depth") + 2, F.lit(1)))).otherwise(F.lit(0).cast("long")).alias("nexts"))
             .groupBy("depth", "node", "ch").agg(F.max("n").alias("n"), F.bit_or("nexts").alias("nexts")))
    return edges.groupBy("depth", "node").agg(F.collect_list(F.struct("ch", "n", "nexts")).alias("edges"))     # at most one edge per letter


STATE = "struct<at: int, node: string, node_n: bigint, edits: int>"


def _step() -> Column:
    """States that follow a state joined with its node's edges."""
    at, edits, size = F.col("at"), F.col("edits"), F.char_length("spelled")
    here, after = F.substring("spelled", at + 1, F.lit(1)), F.substring("spelled", at + 2, F.lit(1))

    def state(at, edge, edits):
        return F.struct(at.cast("int").alias("at"), F.concat("node", edge["ch"]).alias("node"), edge["n"].alias("node_n"), edits.cast("int").alias("edits"))
    none = F.array().cast(f"array<{STATE}>")
    one = F.lit(1)

    def leads_on(edge, read):
        """With its edit made and ``read`` code points used, a word can go on behind this edge, or ends with it."""
        rest = F.substring("spelled", read + 1, F.lit(1))
        return F.when(read == size, edge["n"].isNotNull()).otherwise(edge["nexts"].bitwiseAND(_bit(rest)) != 0)
    follow = F.transform(F.filter("edges", lambda e: (e["ch"] == here) & ((edits == 0) | leads_on(e, at + 1))), lambda e: state(at + 1, e, edits))
    other = F.filter("edges", lambda e: (e["ch"] != here) | (at == size))
    insert = F.transform(F.filter(other, lambda e: leads_on(e, at)), lambda e: state(at, e, one))
    replace = F.when(at < size, F.transform(F.filter(other, lambda e: leads_on(e, at + 1)), lambda e: state(at + 1, e, one))).otherwise(none)
    # the word's own code point is skipped: the next one is followed, at a place where it is another one
    skip = F.when((at + 1 < size) & (here != after),
                  F.transform(F.filter("edges", lambda e: (e["ch"] == after) & leads_on(e, at + 2)), lambda e: state(at + 2, e, one))).otherwise(none)
    # reading forward the second half of a word is edited, reading backward the first; the mark is one code point
    backward = F.when(F.col("spelled").startswith(BACKWARD), 1).otherwise(0)
    may_edit = (edits == 0) & (at - 1 >= F.floor((size - 1 + backward) / 2))
    return F.when(may_edit, F.concat(follow, insert, replace, skip)).otherwise(follow)


def _found() -> Column:
    """The state has read its whole word with one edit at the end of a word; or one code point is left, at the end of one."""
    whole = (F.col("edits") == 1) & (F.col("at") == F.char_length("spelled"))
    skips_last = (F.col("edits") == 0) & (F.col("at") == F.char_length("spelled") - 1)
    return (whole | skips_last) & F.col("node_n").isNotNull()


def _word(spelled: str) -> Column:
    return F.when(F.col(spelled).startswith(FORWARD), F.substr(spelled, F.lit(2))).otherwise(F.reverse(F.substr(spelled, F.lit(2))))


def neighbours(words: DataFrame, small_table: int = SMALL_TABLE) -> DataFrame:
    """``word, near, near_n``: every ordered pair of words (columns ``word, n``, each word once) one edit apart.

    One round per depth of the trie. Each round writes its frontier and the
    pairs it found to the shared folder; the last frontier then goes. Words are
    read from both ends and edited in their second half only, so states leave
    the path where the trie is no longer dense. The nodes of a depth are joined
    by broadcast where their measured number allows it (always near the root,
    where few nodes carry all states: at most one node per letter and level),
    else by shuffle.
    """
    spelled = spellings(words)
    nodes = materialize(trie(spelled), "trie")
    sizes = {r["depth"]: r["k"] for r in nodes.groupBy("depth").agg(F.count("*").alias("k")).collect()}     # one row per depth, at most LONGEST
    states = spelled.select("spelled", F.lit(1).alias("at"), F.substring("spelled", 1, 1).alias("node"), F.lit(None).cast("long").alias("node_n"), F.lit(0).alias("edits"))
    found, last = [], None
    for depth in range(1, max(sizes, default=0) + 1):
        level = nodes.where(F.col("depth") == depth).select("node", "edges")
        if sizes.get(depth, 0) <= small_table:
            level = F.broadcast(level)
        after = (states.where((F.col("edits") == 0) | (F.col("at") < F.char_length("spelled"))).join(level, "node")
                 .select("spelled", F.explode(_step()).alias("s")).select("spelled", "s.*"))
        states = materialize(after, "frontier", 10_000)
        found.append(materialize(states.where(_found()).select(_word("spelled").alias("word"), _word("node").alias("near"), F.col("node_n").alias("near_n")), "near"))
        if last is not None:
            discard(last)
        last = states
    pairs = reduce(DataFrame.unionByName, found) if found else words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    out = materialize(pairs.distinct(), "near")          # an edit in a run of one letter across the middle is met from both ends
    discard(nodes, *found, *([last] if last is not None else []))
    return out


PRIMES = (2147483647, 2147483629)     # fixed values: the largest primes below 2^31
BASES = (1103515245, 1664525)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n]


def rest_keys(word: str) -> tuple[int, np.ndarray]:
    """A 62-bit key of the word, and of what is left of it without each code point, in linear time."""
    c = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    whole, rest = 0, np.zeros(len(c), np.int64)
    for base, prime in zip(BASES, PRIMES):
        p = np.uint64(prime)
        s = np.concatenate([[np.uint64(0)], np.cumsum(c * _powers(base, prime, len(c)) % p, dtype=np.uint64)])
        after = (s[-1] - s[1:]) % p * np.uint64(pow(base, -1, prime)) % p       # those behind the gap move up one place
        rest = rest << 31 | ((s[:-1] + after) % p).astype(np.int64)
        whole = whole << 31 | int(s[-1] % p)
    return whole, rest


def _keys(batches):
    for pdf in batches:
        for i, word in zip(pdf["id"], pdf["word"]):
            whole, rest = rest_keys(word)
            place = np.arange(len(word))
            run = np.array([k == 0 or word[k] != word[k - 1] for k in range(len(word))])
            yield pd.DataFrame({"id": i, "place": np.append(place, -1), "first": np.append(run, True), "key": np.append(rest, whole)})


def long_neighbours(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``word, near, near_n`` of the pairs of which one word at least has more than ``longest`` code points.

    ``words`` are the words of at least ``longest`` code points. Words that are
    equal but for the code point at one place are at most as many as there are
    letters, so a group's pairs are links all and few. Equal keys are checked on
    the words.
    """
    coded = words.select(F.xxhash64("word").alias("id"), "word", "n")
    keys = materialize(coded.select("id", "word").mapInPandas(_keys, "id long, place int, first boolean, key long"), "rests")
    lengths = coded.select("id", (F.char_length("word") > longest).alias("over"))
    rests = keys.where("place >= 0").join(lengths.where("over"), "id")
    shorter = (rests.where("first").select(F.col("id").alias("a"), "key")
               .join(keys.where("place < 0").select(F.col("id").alias("b"), "key"), "key").select("a", "b"))
    same = rests.groupBy("place", "key").agg(F.collect_set("id").alias("ids")).where("size(ids) > 1")
    same = same.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b")).where("a <> b")
    pairs = shorter.unionByName(shorter.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(same).distinct()
    side = lambda x: coded.select(F.col("id").alias(x), F.col("word").alias(f"word_{x}"), F.col("n").alias(f"n_{x}"))     # noqa: E731
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(F.levenshtein("word_a", "word_b", 1) == 1)
            .select(F.col("word_a").alias("word"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")).distinct())


def group_variants(words: DataFrame, small_table: int = SMALL_TABLE, longest: int = LONGEST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word (``words``: ``word, n``, each word once).

    ``n_near``: words one edit away. ``form``: of these the one with the largest
    n (ties: the smallest in code-point order) if it has at least ``TIMES``
    times the word's n, else null. ``root``: where following forms ends, the word
    itself if it has no form. Along forms n grows ``TIMES`` times at each step,
    so chains are short; they are followed by pointer doubling.
    """
    length = F.char_length("word")
    near = neighbours(words.where(length <= longest), small_table)
    far = words.where(length >= longest)
    if not far.where(length > longest).isEmpty():
        near = near.unionByName(long_neighbours(far, longest))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = F.col("best.less") * -1 >= F.col("n") * TIMES
    forms = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"),
        F.when(formed, -F.col("best.less")).alias("form_n")), "forms")
    most = forms.agg(F.max("form_n")).first()[0]
    root = forms.where("form is not null").select("word", F.col("form").alias("root"))
    steps = 1
    while most is not None and TIMES ** steps <= most:      # a chain of k forms ends at TIMES ** k occurrences at least
        up = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = materialize(root.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        steps *= 2
    return (forms.join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``group_variants`` of the ``vocabulary`` of all texts.

    Null texts and texts without letters add nothing; repeated rows count each;
    extra columns are ignored; an empty table gives no rows.
    """
    return group_variants(materialize(vocabulary(docs), "vocabulary"))
