"""Plain Python versions of the operators, for small fixtures."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard_links(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    sets = [(d, s) for d, s in sets if s]
    return [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if 100 * len(x & y) >= percent * len(x | y)]


def removed(rows, window):
    """Per row: (words, kept words) after removing windows that start in a smaller document."""
    least = {}
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[i : i + window])
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and least[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def top_k(rows, queries, k):
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(rows[q], rows[c])), c) for c in rows if c != q)
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return out


def prefix(docs, order, room):
    """Rows of the longest prefix in ``order`` whose tokens fit; rows of equal order go together."""
    groups = defaultdict(list)
    for d in docs:
        groups[order(d)].append(d)
    taken, used = [], 0
    for key in sorted(groups):
        used += sum(d["n"] for d in groups[key])
        if used > room:
            break
        taken += groups[key]
    return taken
