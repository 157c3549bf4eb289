"""Plain versions of the operators over small lists, for comparison."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    return WORD.findall((text or "").translate(UPPER) if lower else text or "")


def shingles(text, n=5):
    w = words(text, lower=True)
    return frozenset([tuple(w)] if 0 < len(w) < n else zip(*[w[k:] for k in range(n)], strict=False))


def alike(a, b, percent=75):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def components(sets):
    """Smallest id reachable over similar sets, from (id, set) rows."""
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if alike(a, b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in sets}


def without_repeats(rows, window=20):
    """Sorted (id, words, removed, sha) for (id, text) rows; rows may repeat ids."""
    first, out = {}, []
    for i, text in rows:
        w = words(text)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, (i, s)), (i, s))
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (i, s):
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def line_sets(text, n=10):
    return frozenset(text[i:i + n] for i in range(max(1, len(text) - n + 1)))


def multiset_similarity(a, b):
    a, b = Counter(a), Counter(b)
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)
