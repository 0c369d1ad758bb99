"""op1 on many slices: rows go by bundle, and suffix arrays hold what different stretches may have in common."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from habita.llm import suffix_dedup
from habita.llm.suffix_dedup import FOUND, WIDTH

from . import brute

PARTS, DEAL = 4, 3


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(11)
    words = ["w%d" % i for i in range(500)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))      # noqa: E731
    passage, line, out = say(80), say(14), []
    for k in range(60):
        t = say(rnd.choice([5, 60, 150]))
        if k % 4 == 0:
            a = rnd.randrange(200)
            t += " " + passage[a:a + rnd.randrange(60, 200)] + " " + say(20)
        if k % 3 == 0:
            t += " " + line + " " + say(3)
        out.append(t)
    return out + ["aaaa" * 60, "b" + "aaaa" * 50, "aaaa" * 40 + "c"]


@pytest.fixture
def tiny(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1500)
    monkeypatch.setattr(suffix_dedup, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    return monkeypatch


def batches(texts, **more):
    rows = {"doc_id": list(range(len(texts))), "name": [1000 + i for i in range(len(texts))], "text": texts, **more}
    table = pa.table({k: pa.array(v, pa.binary() if k == "keys" else None) for k, v in rows.items()})
    return table.to_batches(max_chunksize=5)


def found(texts, popular):
    """Spans per document by the steps that run in tasks, and how many rows the two exchanges carry."""
    grams = [r for b in suffix_dedup._anchor_keys(PARTS)(iter(batches(texts))) for r in b.to_pylist()]
    shared = [suffix_dedup._shared_keys(popular, 1)(g) for _, g in pd.DataFrame(grams).groupby("part")]
    keys = suffix_dedup._keys_by_text(pd.concat(shared)).set_index("name")["keys"].to_dict()
    has = [i for i in range(len(texts)) if 1000 + i in keys]
    docs = [b.filter(pa.array([i in has for i in b.column("doc_id").to_pylist()])) for b in batches(texts, keys=[keys.get(1000 + i, b"") for i in range(len(texts))])]
    rows = pd.DataFrame([r for b in suffix_dedup._stretches(PARTS, DEAL)(iter(d for d in docs if d.num_rows)) for r in b.to_pylist()])
    runs = pd.concat([suffix_dedup._search(g.reset_index(drop=True)) for _, g in rows.groupby("part")])
    spans = {}
    for uid, uses in rows.groupby("uid"):
        mine = runs[runs["uid"] == uid] if len(runs) else pd.DataFrame(columns=[c.split()[0] for c in FOUND.split(", ")])
        for r in suffix_dedup._spans(uses, mine).itertuples():
            spans.setdefault(r.doc_id, []).append(r.spans)
    return spans, len(grams), len(rows)


@pytest.mark.parametrize("popular", [2000, 1])
def test_rows_go_by_bundle_and_not_by_slice(texts, tiny, popular):
    want = brute.without_repeats(list(enumerate(texts)))
    sizes = []
    for most in (1 << 20, 4000, 1):             # all slices in one bundle, some, each in its own
        for x in ("BUNDLE_KEYS", "BUNDLE_BYTES", "BUNDLE_USES"):
            tiny.setattr(suffix_dedup, x, most)
        spans, *n = found(texts, popular)
        got = {i: suffix_dedup._cut(t.encode(), spans.get(i), False) for i, t in enumerate(texts)}
        assert got == want
        sizes.append(n)
    assert sum(n for _, n in want.values()) > 20
    assert sizes[0] == [PARTS, DEAL]            # one row a part, however many slices there are
    assert sizes[0] < sizes[1] < sizes[2] and sizes[2][0] > 5 * PARTS


def test_arrays_hold_only_what_may_have_a_window_in_common(monkeypatch):
    rnd = random.Random(2)
    noise = lambda n: bytes(rnd.randrange(97, 123) for _ in range(n))      # noqa: E731
    first = noise(120)
    b, (doc, begin, last, place, *_, left, right) = np.frombuffer(first, np.uint8), suffix_dedup.anchors(np.frombuffer(first, np.uint8), np.array([120]))
    i = int(np.argmax(last - begin))
    assert last[i] > begin[i]
    own = first[begin[i]:last[i] + WIDTH]
    near = own[:-1] + (b"0" if own[-1:] != b"0" else b"1")                 # another last byte: all windows but one are the same
    alone = [noise(WIDTH + 5) for _ in range(50)]
    single = [own[:WIDTH - 17] + noise(17) for _ in range(2)]             # windows that went one by one
    arrays, whole = [], suffix_dedup.equal_windows
    monkeypatch.setattr(suffix_dedup, "equal_windows", lambda c, *more: arrays.append(c.tobytes()) or whole(c, *more))

    def search(texts):
        lengths = np.array([len(x) for x in texts])
        blob = suffix_dedup._squeeze(b"".join(texts), lengths.astype("<i2"), np.arange(len(texts), dtype="<i8") + 1, np.ones(len(texts), np.int8))
        r = suffix_dedup._search(pd.DataFrame([(7, 0, len(texts), int(lengths.sum()), blob)], columns=["uid", "part", "n", "size", "stretches"])).iloc[0]
        spread = {}
        for o, x, y, low in zip(*(np.frombuffer(r[c], t).tolist() for c, t in (("owner", "<i4"), ("first", "<i4"), ("last", "<i4"), ("least", "<i8")))):
            spread.update({(o, k): low for k in range(x, y + 1)})
        return spread

    texts = [*alone, own, near]
    least = {}
    for o, t in enumerate(texts):
        for k in range(len(t) - WIDTH + 1):
            least.setdefault(t[k:k + WIDTH], o + 1)
    assert search(texts) == {(o, k): least[t[k:k + WIDTH]] for o, t in enumerate(texts) for k in range(len(t) - WIDTH + 1)}
    assert arrays == [own + near]
    arrays.clear()
    assert search(single) == {(0, 0): 1, (1, 0): 2} and arrays == []
