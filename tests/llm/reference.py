"""Plain restatements of the contracts, for comparison on small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def measures(text):
    text = text or ""
    w = words(text)
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows):
    """doc_id to (set size, smallest doc_id reachable)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    seen = set()
    for ids in by.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}
