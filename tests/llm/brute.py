"""Plain versions of the operators, for small inputs."""

import hashlib


def repeats(texts, length):
    """n_removed, n_spans and kept digest per text, by looking up every string."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=5):
    import re

    words = re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard(texts, threshold=0.8):
    """Number of links and class (smallest position) per text, comparing all pairs that share a shingle."""
    sets = [shingles(t) for t in texts]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    links, up = [0] * len(sets), list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        count = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    count[j] = count.get(j, 0) + 1
        for j, n in count.items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return links, [root(i) for i in range(len(sets))]
