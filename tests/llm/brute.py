"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def kept_words(docs, window=13):
    """[(id, text)] to [(id, n_words, kept words)], a smaller id removes."""
    first = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), [x for k, x in enumerate(w) if k not in gone]))
    return out


def shingles(text, n=3):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(max(len(w) - n, 0) + 1)} if w else set()


def classes(docs, percent=90, shingle=3):
    """[(id, text)] with distinct ids to {id: (n shingles, least id of its class)}."""
    sets = {i: shingles(t, shingle) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def benchmark_hits(docs, items, window=13):
    """{(id, text): (n_words, n_hit, item ids found)}"""
    wanted = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[k : k + window])].add(str(item))
    sizes = {len(g) for g in wanted}
    out = {}
    for i, text in docs:
        w, hit, found = alnum(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                g = tuple(w[k : k + size])
                if g in wanted:
                    hit |= set(range(k, k + size))
                    found |= wanted[g]
        out[i, text] = (len(w), len(hit), sorted(found))
    return out


def features(text):
    """(words, their characters, symbols, repeated lines, repeated words, lines)"""
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    twice = {k + j for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(twice), len(lines)


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: size} to {source: target}, by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = total - sum(cap * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        out = {s: cap * sizes[s] if s in full else free * weight[s] / share for s in order}
        above = {s for s in order if s not in full and out[s] > cap * sizes[s]}
        if not above:
            return out
        full |= above


def draw(doc_id, seed):
    text = "" if doc_id is None else str(doc_id)
    return int(hashlib.md5(f"{seed}:{text}".encode()).hexdigest()[:13], 16) / (1 << 52)
