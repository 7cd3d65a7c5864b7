"""Plain single-process versions that the operators are held against."""

import re
from collections import defaultdict


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(docs):
    """(id, text) -> {id: (set size, smallest id linked)} over all pairs."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for gram in s:
            having[gram].append(k)
    common = defaultdict(int)
    for rows in having.values():
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for k in range(len(sets)):
        members[find(k)].append(k)
    out = {}
    for rows in members.values():
        least = min(sets[k][0] for k in rows)
        for k in rows:
            out[sets[k][0]] = (len(sets[k][1]), least)
    return out
