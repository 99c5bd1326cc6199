"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts with equal shingle sets are one class. Classes get MinHash values; those that agree
on a band of values meet in a bucket. In a bucket, values are compared a few at a time and a
pair is dropped once the probability of reaching the threshold, given the agreements so far
and a uniform prior, falls below the tolerance. Pairs that stay hold their classes together as
groups. In each group every pair that the pruning leaves is verified exactly on the shingle
sets. Large buckets and groups are cut into blocks, and each pair of blocks is a task of
its own. Counts of links and spanning trees leave the tasks, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import fits
from ..sources.session import settle
from .common import answer, settle_sized, slices, utf8, without
from .components import connected_components
from .wordhash import IS_PLAIN, find_words, hash_runs, hash_spans, mix

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 24, 5
"""A pair at similarity 0.8 meets in no bucket with probability (1 - 0.8**5)**24 = 7e-5."""
TOLERANCE = 1e-5
STEP = 8
"""MinHash values compared between two looks at the posterior."""
BLOCK_CLASSES = 8_192
BLOCK_SHINGLES = 1_000_000
WANTED_CLASSES = 300_000
"""Most classes (60 bytes each) that are broadcast to fetch their texts; beyond it that join is shuffled."""
_VALUES = BANDS * BAND_ROWS
_FACTORS = mix(np.arange(1, _VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, _VALUES + 1001, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    starts, ends, first = find_words(data, offsets, IS_PLAIN)
    hashes, before = hash_runs(hash_spans(data, starts, ends), first, SHINGLE)
    return [np.unique(hashes[a:b]) for a, b in zip(before[:-1], before[1:])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (texts, BANDS * BAND_ROWS) of sets, none of them empty."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), _VALUES), np.uint32)
    for k in range(_VALUES):
        out[:, k] = np.minimum.reduceat(((joined * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, fewest agreements to go on): below, P(similarity >= threshold) < tolerance.

    With a uniform prior that probability is the chance of at most m successes in k + 1
    trials at the threshold.
    """
    out = []
    for k in range(STEP, _VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append((k, m))
    return out


def surviving(one: np.ndarray, many: np.ndarray, least: list[tuple[int, int]]) -> np.ndarray:
    """Rows of ``many`` that the pruning leaves for ``one``."""
    rows, agreed, at = np.arange(len(many)), np.zeros(len(many), np.int32), 0
    for k, m in least:
        agreed = agreed + (many[rows, at:k] == one[at:k]).sum(1, dtype=np.int32)
        stay = agreed >= m
        rows, agreed, at = rows[stay], agreed[stay], k
        if not len(rows):
            break
    return rows


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


_SIGNED = "id long, name string, h long, key binary, n int, sig binary"


def _signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row its class key (128 bits over the shingle set), the set's size and MinHash values, 16 bits of each."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, sigs = [], [], []
            for _, _, data, offsets in slices(batch.column("body")):
                sets = shingle_sets(data, offsets)
                full = [s for s in sets if len(s)]
                values = iter(signatures(full).astype(np.uint16)) if full else iter(())
                for s in sets:
                    sizes.append(len(s))
                    if not len(s):
                        keys.append(None)
                        sigs.append(None)
                        continue
                    keys.append(mix(s).sum(dtype=np.uint64).tobytes() + mix(s ^ np.uint64(0x5555)).sum(dtype=np.uint64).tobytes())
                    sigs.append(next(values).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("name"), batch.column("h"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary())], names=["id", "name", "h", "key", "n", "sig"])

    return _bodies(docs, doc_id, text).mapInArrow(sign, _SIGNED)


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = utf8(F.col(text))
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("name"), F.xxhash64(body).alias("h"), body.alias("body"))


def _bands(classes: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(batch.num_rows, BANDS, BAND_ROWS).astype(np.uint64)
            h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sigs.shape[:2])
            for k in range(BAND_ROWS):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sigs[:, :, k])
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), batch.column("key").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))], names=["bucket", "key"])

    return classes.select("key", "sig").mapInArrow(emit, "bucket long, key binary")


def _blocks(blocks: Column, key: Column) -> Column:
    """The pairs of blocks (low, high, own) that a row of a bucket or group goes to: one unless it is large."""
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks.cast("int") - 1), lambda o: F.struct(F.least(o, own).alias("low"), F.greatest(o, own).alias("high"), own.alias("own")))
    return F.when(blocks <= 1, F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("own")))).otherwise(pairs)


def _groups_of(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows with equal values of ``by`` from sorted batches."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[c] for c in by)
            if now != at and rows:
                yield at, rows
                rows = []
            at = now
            rows.append(row)
    if rows:
        yield at, rows


def _candidate_edges(classes: DataFrame, threshold: float, tolerance: float, block: int) -> DataFrame:
    """Edges (a, b) that connect all classes whose pair in some bucket survives the pruning."""
    least = least_agreements(threshold, tolerance)
    rows = settle(_bands(classes))
    buckets = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = answer(rows, buckets, ["bucket"], ["size"], "size", rows.count()).filter("size is not null")
    blocks = F.ceil(F.col("size") / block)
    placed = shared.select("bucket", "key", F.explode(_blocks(blocks, F.col("key"))).alias("p")).select("bucket", "key", "p.*")
    signed = placed.join(classes.select("key", "sig"), "key")
    owned = signed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "key")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, rows in _groups_of(batches, ("bucket", "low", "high")):
            sigs = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint16).reshape(len(rows), -1)
            forest = _Forest(len(rows))
            names = np.arange(len(rows))
            for i in range(len(rows) - 1):
                others = i + 1 + np.flatnonzero(names[i + 1 :] != names[i])
                for j in others[surviving(sigs[i], sigs[others], least)].tolist():
                    if forest.join(i, j):
                        out.append((rows[i]["key"], rows[j]["key"]))
                        old, new = names[j], names[i]
                        names[names == old] = new
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], names=["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return owned.mapInArrow(prune, "a binary, b binary")


def linked_pairs(sets: list[np.ndarray], sigs: np.ndarray, own: np.ndarray, crossing: bool, threshold: float, least: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the later ones that are linked to it: pruned by MinHash values, verified by exact intersections.

    Shingles that many of the sets have are counted by a matrix product, the others from
    lists of the sets that have them. ``crossing`` leaves out pairs within one block.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    of = np.repeat(np.arange(m), sizes)
    _, shingle, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = (df * 8 >= m) & (df > 16)
    column = np.cumsum(often) - 1
    dense = np.zeros((m, int(often.sum())), np.float32)
    hit = often[shingle]
    dense[of[hit], column[shingle[hit]]] = 1
    rare = ~hit & (df[shingle] > 1)
    order = np.argsort(shingle[rare], kind="stable")
    holders, start = of[rare][order], np.concatenate([[0], np.cumsum(np.where(often | (df < 2), 0, df))])
    first = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(m - 1):
        later = i + 1 + surviving(sigs[i], sigs[i + 1 :], least)
        if crossing:
            later = later[own[later] != own[i]]
        if not len(later):
            continue
        shared = dense[later] @ dense[i]
        mine = shingle[first[i] : first[i + 1]]
        mine = mine[~often[mine] & (df[mine] > 1)]
        spans = start[mine + 1] - start[mine]
        places = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum()) if len(mine) else np.zeros(0, np.int64)
        shared = shared + np.bincount(holders[places], minlength=m)[later]
        union = sizes[i] + sizes[later] - shared
        yield i, later[shared >= threshold * union - 1e-9]


_LINKS = "kind int, key binary, other binary, links long"


def _verified(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Rows of kind 0 (key, other: its class in a group of one block), 1 (key, other: an edge) and 2 (key, links)."""
    least = least_agreements(threshold, tolerance)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), rows in _groups_of(batches, ("group", "low", "high")):
            rows = list({r["key"]: r for r in rows}.values())
            sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
            sigs = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint16).reshape(len(rows), -1)
            own, weights = np.array([r["own"] for r in rows]), np.array([r["weight"] for r in rows])
            forest, links, edges = _Forest(len(rows)), np.zeros(len(rows), np.int64), []
            for i, later in linked_pairs(sets, sigs, own, low != high, threshold, least) if len(rows) > 1 else ():
                links[i] += weights[later].sum()
                links[later] += weights[i]
                edges += [(i, j) for j in later.tolist() if forest.join(i, j)]
            keys = [r["key"] for r in rows]
            out = [(2, k, None, int(n)) for k, n in zip(keys, links) if n]
            if rows[0]["blocks"] <= 1:
                out += [(0, keys[i], keys[forest.root(i)], None) for i in range(len(rows))]
            else:
                out += [(1, keys[i], keys[j], None) for i, j in edges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.int64()))], names=["kind", "key", "other", "links"])

    owned = members.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "key")
    return owned.mapInArrow(verify, _LINKS)


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block_classes: int = BLOCK_CLASSES, block_shingles: int = BLOCK_SHINGLES, wanted: int = WANTED_CLASSES) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept per row of ``docs``.

    Words are letters, digits and non-ASCII, A-Z lower-cased; shingles are runs of five, a
    shorter text is one shingle. Two rows are linked if their shingle sets have Jaccard
    similarity of ``threshold`` or more; ``n_links`` counts a row's links, copies
    included. A class is what links connect, named by its smallest doc_id, whose row is
    ``kept``; null ids come last, and of rows that repeat the smallest id one text is kept.
    Text without words, null included, is linked to nothing and kept. An empty table gives
    an empty result.
    """
    signed = settle(_signed(docs, doc_id, text))
    total = signed.count()
    worded = signed.filter("n > 0")
    classes = settle_sized(worded.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "name", "h")).alias("least"), F.count("*").alias("weight"), F.first("n").alias("n"), F.first("sig").alias("sig")), total)
    edges = settle(_candidate_edges(classes, threshold, tolerance, block_classes))
    groups = settle_sized(connected_components(edges).select(F.col("node").alias("key"), F.col("component").alias("group")), total)
    grouped = groups.count()

    sized = groups.join(classes, "key")
    totals = settle_sized(sized.groupBy("group").agg(F.sum("n").alias("shingles"), F.count("*").alias("members")), grouped)
    blocks = F.greatest(F.ceil(F.col("shingles") / block_shingles), F.ceil(F.col("members") / block_classes)).alias("blocks")
    placed = answer(sized, totals.select("group", "members", blocks), ["group"], ["blocks"], "members", grouped)
    chosen = settle_sized(placed.select("group", "key", "weight", "sig", "blocks", "least.name", "least.h"), grouped)
    lookup = chosen.select("name", "h", "key")
    bodies = _bodies(docs, doc_id, text).select("name", "h", "body")
    texts = bodies.join(F.broadcast(lookup) if fits(lookup, wanted) else lookup, ["name", "h"]).select("key", "body")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in slices(batch.column("body")):
                made = pa.array([s.tobytes() for s in shingle_sets(data, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(begin, end - begin), made], names=["key", "shingles"])

    sets = texts.mapInArrow(cut, "key binary, shingles binary")
    members = chosen.drop("name", "h").join(sets, "key").withColumn("p", F.explode(_blocks(F.col("blocks"), F.col("key")))).select("group", "key", "weight", "sig", "blocks", "shingles", "p.*")
    found = settle(_verified(members, threshold, tolerance))

    links = found.filter("kind = 2").groupBy("key").agg(F.sum("links").alias("links"))
    local = found.filter("kind = 0").select("key", F.col("other").alias("class"))
    across = found.filter("kind = 1").select(F.col("key").alias("a"), F.col("other").alias("b"))
    if not across.isEmpty():
        local = local.unionByName(connected_components(across).select(F.col("node").alias("key"), F.col("component").alias("class")))
    labelled = classes.select("key", "least", "weight").join(local, "key", "left").join(links, "key", "left").withColumn("class", F.coalesce("class", "key"))
    named = labelled.groupBy("class").agg(F.min("least").alias("first"), F.sum("weight").alias("class_size"), F.count("*").alias("classes"))
    answers = settle_sized(answer(labelled, named, ["class"], ["first", "class_size"], "classes", classes.count()).select("key", "weight", "first", "class_size", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), total)
    rows = answer(signed.select("id", "name", "h", F.coalesce("key", F.lit(b"")).alias("key")), answers, ["key"], ["first", "class_size", "n_links"], "weight", total)
    alone = F.col("first").isNull()
    return rows.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (alone | ((F.col("name") == F.col("first.name")) & (F.col("h") == F.col("first.h")))).alias("kept"),
        "name",
        "h",
    )


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class; of rows that repeat a kept id and text one stays."""
    found = settle(jaccard_join(docs, doc_id, text, **options))
    dropped = found.filter("not kept").select("name", "h").distinct()
    again = found.filter("kept and n_links > 0").groupBy("name", "h").count().filter("count > 1")
    keys = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.xxhash64(utf8(F.col(text)))]
    return without(docs, keys, dropped, once=not again.isEmpty())
