"""Words of many texts at once: where they are, and 64-bit hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np

_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
IS_SPACE = np.array([c in _SPACES for c in range(256)])
IS_PLAIN = np.array([not (c >= 0x80 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122) for c in range(256)])
"""Separators of the two kinds of words: by white space, and runs of letters, digits and non-ASCII bytes."""
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


_held: dict[int, np.ndarray] = {}


def _powers(size: int, base: int) -> np.ndarray:
    if base not in _held or len(_held[base]) < size:
        p = np.full(-(-size // (1 << 20)) << 20, np.uint64(base), np.uint64)
        p[0] = 1
        _held[base] = np.multiply.accumulate(p)
    return _held[base]


def find_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of words before it (one more at the end)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~separator[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins[:-1])
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the lower-cased bytes of each span: a polynomial modulo 2**64 from running sums, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1, int(_BASE)), _powers(len(data) + 1, int(_INVERSE))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[LOWER[data]] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_runs(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``length`` words inside a text, and for each text the number of runs before it.

    ``first`` is as find_words returns it. A text with fewer words, but at least one, is one run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    before = np.zeros(len(first), np.int64)
    np.cumsum(runs, out=before[1:])
    out = np.zeros(before[-1], np.uint64)
    if len(words) >= length:
        full = np.zeros(len(words) - length + 1, np.uint64)
        for k in range(length):
            full = full * _BASE + words[k : k + len(full)]
        where = np.repeat(first[:-1] - before[:-1], runs) + np.arange(before[-1])
        whole = np.repeat(counts >= length, runs)
        out[whole] = full[where[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < length)):
        h = int(counts[i])
        for w in words[first[i] : first[i + 1]].tolist():
            h = (h * int(_BASE) + w) % (1 << 64)
        out[before[i]] = h
    return mix(out), before
