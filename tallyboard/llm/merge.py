"""Distributed merge sort of byte strings: front-coded sorted runs and a loser tree that knows common prefixes.

A map task sorts what it holds into runs, cuts them at the splitters of the ranges and
sends each piece front-coded: the length of the prefix a string shares with the one
before it, and the rest. One task combines the pieces of a range. Its loser tree keeps
for every waiting string the length of the prefix it shares with the last one put out;
a longer prefix wins at once, and only equal ones are compared, from there on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

RUN_BYTES = 24 << 20
"""Bytes of strings and values a map task sorts at once."""
SAMPLES = 8
"""Sampled strings per range from which splitters are taken."""

Item = tuple[bytes, bytes]
"""A string and the value that travels with it."""


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings that share their first ``at`` bytes."""
    end = min(len(a), len(b))
    if a[at:end] == b[at:end]:
        return end
    step = 16
    while a[at : at + step] == b[at : at + step]:
        at += step
        step *= 2
    end = min(end, at + step)
    odd = int.from_bytes(a[at:end], "big") ^ int.from_bytes(b[at:end], "big")
    return end - (odd.bit_length() + 7) // 8


def merge(runs: Iterable[Iterator[tuple[bytes, int, bytes]]]) -> Iterator[tuple[bytes, int, bytes]]:
    """Merge sorted runs of (string, prefix shared with the run's string before, value).

    Yields (string, prefix shared with the string put out before, value); equal strings
    come in the order of their runs.
    """
    sources = list(runs)
    if not sources:
        return
    size = 1 << (len(sources) - 1).bit_length()
    heads = [next(s, None) for s in sources] + [None] * (size - len(sources))
    shared = [0] * size

    def play(i: int, j: int) -> tuple[int, int]:
        a, b = heads[i], heads[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if shared[i] != shared[j]:
            return (i, j) if shared[i] > shared[j] else (j, i)
        same = common(a[0], b[0], shared[i])
        x, y = a[0][same : same + 1], b[0][same : same + 1]
        if x < y or (x == y and i < j):
            shared[j] = same
            return i, j
        shared[i] = same
        return j, i

    losers, level = [0] * size, list(range(size))
    while len(level) > 1:
        half = len(level) // 2
        pairs = [play(level[2 * k], level[2 * k + 1]) for k in range(half)]
        losers[half : 2 * half] = [loser for _, loser in pairs]
        level = [winner for winner, _ in pairs]
    best = level[0]
    while (head := heads[best]) is not None:
        yield head[0], shared[best], head[2]
        heads[best] = following = next(sources[best], None)
        shared[best] = following[1] if following else 0
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


def encode(items: list[Item], prefixes: list[int]) -> bytes:
    """Front-code a sorted run; ``prefixes`` are the lengths shared with the item before."""
    tails = [key[n:] for (key, _), n in zip(items, prefixes)]
    sizes = np.array([prefixes, [len(t) for t in tails], [len(v) for _, v in items]], np.uint32)
    raw = np.uint32(len(items)).tobytes() + sizes.tobytes() + b"".join(tails) + b"".join(v for _, v in items)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def decode(blob: bytes) -> Iterator[tuple[bytes, int, bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    prefixes, tails, values = np.frombuffer(raw, np.uint32, 3 * n, 4).reshape(3, n).tolist()
    at, value_at, key = 4 + 12 * n, 4 + 12 * n + sum(tails), b""
    for prefix, tail, value in zip(prefixes, tails, values):
        key = key[:prefix] + raw[at : at + tail]
        at += tail
        yield key, prefix, raw[value_at : value_at + value]
        value_at += value


def cut_run(items: list[Item], splitters: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Sort items and front-code them by range; range k holds what is not below splitter k - 1."""
    items.sort(key=lambda item: item[0])
    part: list[Item] = []
    prefixes: list[int] = []
    at = 0
    for item in items:
        if at < len(splitters) and item[0] >= splitters[at]:
            if part:
                yield at, encode(part, prefixes)
            part, prefixes = [], []
            lo, hi = at + 1, len(splitters)
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if item[0] >= splitters[mid] else (lo, mid)
            at = lo
        prefixes.append(common(part[-1][0], item[0], 0) if part else 0)
        part.append(item)
    if part:
        yield at, encode(part, prefixes)


def pick_splitters(keys: DataFrame, ranges: int) -> list[bytes]:
    """Splitters for about ``ranges`` ranges of the strings in the one column of ``keys``.

    About SAMPLES strings per range come to the driver, chosen by hash.
    """
    name = keys.columns[0]
    if ranges < 2:
        return []
    every = max(1, keys.count() // (ranges * SAMPLES))
    found = sorted(bytes(r[0]) for r in keys.filter(F.pmod(F.xxhash64(name), F.lit(every)) == 0).collect())
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def send_runs(rows: DataFrame, splitters: list[bytes], run_bytes: int = RUN_BYTES) -> DataFrame:
    """(range, run, blob) of sorted front-coded runs from rows of (key binary, value binary)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Item] = []
        size = 0

        def flush() -> pa.RecordBatch:
            run, out = uuid.uuid4().hex, list(cut_run(held, splitters))
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int32()), pa.array([run] * len(out)), pa.array([b for _, b in out], pa.binary())], names=["range", "run", "blob"])

        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                held.append((key, value))
                size += len(key) + len(value) + 100
                if size > run_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return rows.select("key", "value").mapInArrow(build, "range int, run string, blob binary")


def combine_ranges(runs: DataFrame, handle: Callable[[int, list[tuple[str, bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Give the (run, blob) pieces of each range to ``handle``, which merges them.

    A task holds the front-coded pieces of one range at a time.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces = None, []
        for batch in batches:
            for number, run, blob in zip(*(batch.column(c).to_pylist() for c in ("range", "run", "blob"))):
                if number != at and pieces:
                    yield from handle(at, pieces)
                    pieces = []
                at = number
                pieces.append((run, blob))
        if pieces:
            yield from handle(at, pieces)

    return runs.select("range", "run", "blob").repartition("range").sortWithinPartitions("range", "run").mapInArrow(combine, schema)
