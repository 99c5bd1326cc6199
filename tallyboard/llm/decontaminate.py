"""Benchmark decontamination by SimHash windows of an item's size.

Items and documents are runs of words (letters, digits, non-ASCII), compared by shingles
of five words that weigh as many bytes as their words have. A window of an item's size
is laid over a document wherever a shingle of the item stands, in line with it; a
window without any such shingle has similarity 0. Windows and items get 64-bit SimHashes. A
multi-index over eight blocks of eight bits finds every item within the radius: if two
fingerprints differ in at most RADIUS bits, some block differs in at most RADIUS // 8.
What the index finds is verified exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.session import settle
from .common import slices, utf8, without
from .wordhash import IS_PLAIN, find_words, hash_runs, hash_spans, mix

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 26
"""At cosine 0.8 a bit differs with probability 0.205: 13.1 of 64 bits, deviation 3.2. 26 is four deviations above."""
BLOCKS = 8
PASS_BYTES = 16 << 20
"""Bytes of item text that one pass over the documents holds; a larger benchmark takes more passes."""
_BITS = np.arange(64, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes and weights, shingles before each text, words before each text."""
    starts, ends, first = find_words(data, offsets, IS_PLAIN)
    hashes, before = hash_runs(hash_spans(data, starts, ends), first, SHINGLE)
    sums = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=sums[1:])
    counts, runs = np.diff(first), np.diff(before)
    at = np.repeat(first[:-1] - before[:-1], runs) + np.arange(before[-1])
    width = np.repeat(np.minimum(counts, SHINGLE), runs)
    return hashes, sums[at + width] - sums[at], before, first


def simhash(hashes: np.ndarray, weights: np.ndarray) -> int:
    """Weighted majority of the shingles' bits, each shingle with its own multiplicity."""
    bits = ((mix(hashes)[:, None] >> _BITS) & np.uint64(1)).astype(np.int64)
    return int(((2 * bits - 1) * weights[:, None]).sum(0).__gt__(0).astype(np.uint64) @ (np.uint64(1) << _BITS))


def similarity(a: Counter, b: Counter) -> float:
    """Weight of the shared shingles over the weight of the heavier side; keys are (shingle, weight)."""
    shared = sum(min(n, b[k]) * k[1] for k, n in a.items() if k in b)
    return shared / max(1, sum(n * k[1] for k, n in a.items()), sum(n * k[1] for k, n in b.items()))


def _counted(hashes: np.ndarray, weights: np.ndarray) -> Counter:
    return Counter(zip(hashes.tolist(), weights.tolist()))


class ItemIndex:
    """Items by shingle, by size, and by blocks of their SimHashes."""

    def __init__(self, items: list[tuple[int, bytes]], least: float, radius: int):
        offsets = np.cumsum([0, *(len(t) for _, t in items)])
        data = np.frombuffer(b"".join(t for _, t in items), np.uint8)
        hashes, weights, before, first = shingles(data, offsets)
        self.least, self.radius = least, radius
        self.ids = [i for i, _ in items]
        self.runs = np.diff(before)
        spans = [slice(before[k], before[k + 1]) for k in range(len(items))]
        self.sets = [_counted(hashes[s], weights[s]) for s in spans]
        self.prints = np.array([simhash(hashes[s], weights[s]) if s.stop > s.start else 0 for s in spans], np.uint64)
        self.where: dict[int, list[tuple[int, int]]] = {}
        for k, s in enumerate(spans):
            for j, h in enumerate(hashes[s].tolist()):
                self.where.setdefault(h, []).append((k, j))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[hashes >> np.uint64(44)] = True
        self.hashes = np.unique(hashes)
        near = np.array([[bin(a ^ b).count("1") <= radius // BLOCKS for b in range(256)] for a in range(256)])
        self.blocks = {}
        for size in np.unique(self.runs):
            of = np.flatnonzero(self.runs == size)
            parts = np.stack([(self.prints[of] >> np.uint64(8 * b)) & np.uint64(255) for b in range(BLOCKS)]).astype(np.int64)
            self.blocks[int(size)] = (of, [[of[near[v][parts[b]]] for v in range(256)] for b in range(BLOCKS)])

    def near(self, print_: int, size: int) -> np.ndarray:
        """Items of a size whose SimHash is within the radius."""
        if size not in self.blocks:
            return np.zeros(0, np.int64)
        found = np.unique(np.concatenate([self.blocks[size][1][b][print_ >> 8 * b & 255] for b in range(BLOCKS)]))
        gap = np.bitwise_count(self.prints[found] ^ np.uint64(print_))
        return found[gap <= self.radius]

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(44)])
        if not len(maybe) or not len(self.hashes):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == hashes[maybe]]

    def search(self, hashes: np.ndarray, weights: np.ndarray, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """For one document, the best (similarity, first shingle, shingles) of each item that is in it."""
        windows = set()
        for p in hits.tolist():
            for k, j in self.where[int(hashes[p])]:
                size = int(self.runs[k])
                windows.add((max(0, min(p - j, len(hashes) - size)), size))
        best: dict[int, tuple[float, int, int]] = {}
        for start, size in sorted(windows):
            part = slice(start, start + size)
            counted = None
            for k in self.near(simhash(hashes[part], weights[part]), size).tolist():
                counted = counted or _counted(hashes[part], weights[part])
                score = similarity(counted, self.sets[k])
                if score >= self.least and (k not in best or score > best[k][0]):
                    best[k] = (score, start, size)
        return best


_COLUMNS = "doc_id long, h long, item_ids array<long>, scores array<double>, first_words array<long>, window_words array<long>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64())), ("first_words", pa.list_(pa.int64())), ("window_words", pa.list_(pa.int64()))])


def _find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = SIMILARITY, radius: int = RADIUS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """What ``find_leaks`` gives, and the digest h of the text."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), utf8(F.col(item_text)).alias("body"))
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    passes = max(1, -(-total // pass_bytes))
    bodies = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(F.col(text)).alias("body")).withColumn("h", F.xxhash64("body"))
    found = []
    for number in range(passes):
        part = items if passes == 1 else items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(passes)) == number)
        rows = sorted(((r.item, bytes(r.body)) for r in part.collect()), key=lambda r: (r[0] is None, r))

        def search(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(rows, least, radius)
            for batch in batches:
                ids, out = list(zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist())), []
                for begin, end, data, offsets in slices(batch.column("body")):
                    hashes, weights, before, _ = shingles(data, offsets)
                    hits = index.hits(hashes)
                    of = np.searchsorted(before, hits, side="right") - 1
                    finds = {}
                    for k in np.unique(of).tolist():
                        lo, hi = before[k], before[k + 1]
                        finds[k] = sorted(index.search(hashes[lo:hi], weights[lo:hi], hits[of == k] - lo).items())
                    for k in range(end - begin):
                        got = finds.get(k, [])
                        out.append((*ids[begin + k], [index.ids[i] for i, _ in got], [s for _, (s, _, _) in got], [a for _, (_, a, _) in got], [n + SHINGLE - 1 for _, (_, _, n) in got]))
                yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in out], schema=_ARROW)

        found.append(bodies.mapInArrow(search, _COLUMNS))
    if passes == 1:
        return found[0]
    lists = ("item_ids", "scores", "first_words", "window_words")
    hits = [part.filter(F.size("item_ids") > 0).select(F.col("doc_id").alias("of"), F.col("h").alias("of_h"), F.lit(number).alias("pass"), F.struct(*lists).alias("hit")) for number, part in enumerate(found)]
    union = hits[0]
    for more in hits[1:]:
        union = union.unionByName(more)
    grouped = union.dropDuplicates(["of", "of_h", "pass"]).groupBy("of", "of_h").agg(F.collect_list("hit").alias("hits"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h"))
    return bodies.select("doc_id", "h").join(grouped, same, "left").select("doc_id", "h", *[F.flatten(F.coalesce(F.col("hits")[c], F.array())).alias(c) for c in lists])


def find_leaks(docs: DataFrame, benchmark: DataFrame, *args, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id and arrays of the items in it with similarity, window start and size in words.

    Null texts count as empty; empty texts and items match nothing. A text or item of
    one to four words is one shingle of its own length. A text shorter than an item is one
    window. Items are held pass by pass, ``pass_bytes`` at a time (a longer item is a
    pass of its own); the finds of several passes are put together per id and text, so
    repeated rows repeat.
    """
    return _find_leaks(docs, benchmark, *args, **options).drop("h")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, by id and text; a null id is an id like others."""
    found = _find_leaks(docs, benchmark, doc_id, text, **options)
    leaked = settle(found.filter(F.size("item_ids") > 0).select("doc_id", "h").distinct())
    return without(docs, [F.col(doc_id).cast("long"), F.xxhash64(utf8(F.col(text)))], leaked)
