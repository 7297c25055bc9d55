"""Plain Python twins of the corpus operators, straight from their definitions."""

import hashlib
import re
import string
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(n, linked):
    """The smallest reachable index for each of n."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def substring(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        out.append((doc, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def simhash(text, width, seed=42):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def leaks(rows, items, width=10):
    grams = defaultdict(set)
    for item, text in items:
        w = NORMAL.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w = NORMAL.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if got := grams.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= got
        out.append((doc, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out
