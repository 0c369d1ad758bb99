"""Plain versions of the operators, for small inputs."""

import re

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_links(sets):
    ids = sorted(sets)
    out = []
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                out.append((ids[x], ids[y]))
    return out


def without_repeats(texts, width=50):
    """doc_id -> (kept bytes, number of removed runs); texts: list of (doc_id, text) in any order."""
    first = {}
    for i, t in texts:
        b = (t or "").encode()
        for s in range(len(b) - width + 1):
            w = b[s:s + width]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in texts:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - width + 1):
            if first[b[s:s + width]] < i:
                gone[s:s + width] = [True] * width
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (bytes(x for x, g in zip(b, gone) if not g), runs)
    return out
