"""Near-duplicates written again: whole-text longest common subsequences of all pairs."""

import re


def words(text):
    return [w.lower() for w in re.findall(r"[^\W_]+", text or "")]


def similarity(a, b):
    """m / (n1 + n2 - m) of the longest common subsequence of words; texts of under five words are alike only if equal."""
    if not a or not b or (min(len(a), len(b)) < 5 and a != b):
        return 0.0
    where, full = {}, (1 << len(a)) - 1
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    v = full
    for x in b:
        u = v & where.get(x, 0)
        v = (v + u | v - u) & full
    m = len(a) - v.bit_count()
    return m / (len(a) + len(b) - m)


def links(texts, least=0.8):
    """Pairs of places of linked texts."""
    split = [words(t) for t in texts]
    near = [(i, j) for i in range(len(split)) for j in range(i) if 0.8 * len(split[i]) <= len(split[j]) + 1 and 0.8 * len(split[j]) <= len(split[i]) + 1]
    return [(i, j) for i, j in near if similarity(split[i], split[j]) >= least - 1e-9]


def classes(n, pairs):
    """The least place of each place's component."""
    out = list(range(n))
    for i, j in pairs:
        old, new = max(out[i], out[j]), min(out[i], out[j])
        out = [new if c == old else c for c in out]
    return out
