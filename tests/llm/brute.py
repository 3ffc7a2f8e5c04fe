"""Plain Python versions to compare with."""

import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def shingle_set(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts):
    """Smallest id reachable by links, by id."""
    sets, parent, places = {d: shingle_set(t) for d, t in texts.items()}, {d: d for d in texts}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in places[s])
        for e, n in common.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
        for s in sets[d]:
            places[s].append(d)
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def repeated_words(text):
    w = words(text)
    n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if n[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(covered)


def removed_ranges(texts, length, keep_first):
    """Ranges to remove from each text; a window counts wherever it starts again."""
    raws = {d: (t or "").encode() for d, t in texts.items()}
    count, seen = Counter(r[i:i + length] for r in raws.values() for i in range(len(r) - length + 1)), set()
    out = {}
    for d in sorted(raws):
        ranges = []
        for i in range(len(raws[d]) - length + 1):
            window = raws[d][i:i + length]
            if window in seen if keep_first else count[window] > 1:
                if ranges and i <= ranges[-1][1]:
                    ranges[-1][1] = i + length
                else:
                    ranges.append([i, i + length])
            seen.add(window)
        out[d] = [tuple(r) for r in ranges]
    return out
