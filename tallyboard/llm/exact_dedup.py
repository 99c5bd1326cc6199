"""Exact deduplication over an extendible-hash index kept as files in the shared folder.

Every text gets a 64-bit key, the hash of its normalised bytes, and a digest. The index
has one entry per distinct text. Its directory starts with two buckets and doubles as
long as a bucket holds more entries than its capacity: only overfull buckets split, the
others keep their depth. A bucket is a range of keys and is owned by one task. Where a
key occurs more than once, the owner gets the texts (each map task sends equal ones
once), chains different texts of one key and compares their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.joins import fits
from ..sources.session import settle
from .common import answer, lower_ascii, without

CAPACITY = 50_000
MAX_DEPTH = 20
"""The directory has at most 2 ** MAX_DEPTH entries of two numbers, whatever the input."""
WANTED_ROWS = 500_000
"""Most repeated keys (40 bytes each) that are broadcast to fetch their texts; beyond it the join is shuffled."""


def _cell(key: Column, depth: int = MAX_DEPTH) -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def build_directory(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """The directory (cell, bucket, depth) for entries with a ``key``, and its global depth.

    A cell is as many bits of a key as the global depth; a bucket is named by its first
    cell. A bucket that is still overfull at MAX_DEPTH stays so; its owner only takes longer.
    """
    cells = settle(entries.groupBy(_cell(F.col("key")).alias("cell")).agg(F.count("*").alias("load"), F.lit(0).alias("depth")))
    for doubled in range(1, MAX_DEPTH + 1):
        prefix = F.shiftright("cell", MAX_DEPTH - doubled)
        inside = F.sum("load").over(Window.partitionBy(prefix))
        stays = (F.col("depth") == 0) & ((inside <= capacity) | F.lit(doubled == MAX_DEPTH))
        cells = settle(cells.withColumn("depth", F.when(stays, doubled).otherwise(F.col("depth"))))
        if cells.filter("depth = 0").isEmpty():
            break
    own = F.expr(f"shiftleft(shiftright(cell, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)")
    down = MAX_DEPTH - doubled
    placed = cells.select(F.shiftright("cell", down).alias("cell"), F.shiftright(own, down).alias("bucket"), "depth")
    return settle(placed.distinct()), doubled


def _send_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop texts of a map task that equal one it has sent, as far as a bounded memory shows."""
    sent: dict[bytes, int] = {}
    held = 0
    for batch in batches:
        bodies = batch.column("body")
        rows = []
        for i, body in enumerate(bodies):
            raw = body.as_py()
            if raw in sent:
                continue
            if held > 64 << 20:
                sent.clear()
                held = 0
            sent[raw] = 1
            held += len(raw) + 100
            rows.append(i)
        yield batch.take(pa.array(rows, pa.int64()))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner of key ranges, rows sorted by key and digest: one output row per distinct text."""
    at, texts = None, {}
    for batch in batches:
        out = []
        for key, sha, body in zip(*(batch.column(c).to_pylist() for c in ("key", "sha", "body"))):
            if key != at:
                at, texts = key, {}
            if sha not in texts:
                texts[sha] = body
                out.append((key, sha, len(texts)))
            elif texts[sha] != body:
                raise ValueError("two texts share a SHA-256 digest")
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int32())],
            names=["key", "sha", "place"],
        )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, key_bits: int = 64, wanted_rows: int = WANTED_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, chain_place.

    Texts are equal when their bytes are after lower-casing A-Z; null equals empty. The
    largest id of a group stays; null ids lose to others, and a group of null ids
    keeps null. Rows that repeat id and text share one answer. Other columns of
    ``docs`` are ignored, an empty table gives an empty result. ``key_bits`` below 64
    makes keys collide, for tests.
    """
    body = lower_ascii(F.col(text)).cast("binary")
    key = F.xxhash64(body) if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(F.xxhash64(body), 64 - key_bits), 64 - key_bits)
    sha = F.unhex(F.sha2(body, 256))
    keyed = settle(docs.select(F.col(doc_id).alias("id"), key.alias("key"), sha.alias("sha")))
    entries = settle(keyed.groupBy("key", "sha").agg(F.max("id").alias("keep"), F.count("*").alias("n")))
    total = keyed.count()
    directory, depth = build_directory(entries, capacity)

    shared = entries.groupBy("key").agg(F.sum("n").alias("rows")).filter("rows > 1").select("key")
    texts = docs.select(key.alias("key"), sha.alias("sha"), body.alias("body"))
    if fits(shared, wanted_rows):
        texts = texts.join(F.broadcast(shared), "key", "left_semi")
    else:
        texts = texts.join(shared, "key", "left_semi")
    sent = texts.mapInArrow(_send_once, "key long, sha binary, body binary")
    owned = (
        sent.withColumn("cell", _cell(F.col("key"), depth))
        .join(F.broadcast(directory), "cell")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key", "sha")
        .select("key", "sha", "body")
    )
    chains = owned.mapInArrow(_chain, "key long, sha binary, place int")
    index = settle(
        entries.withColumn("cell", _cell(F.col("key"), depth))
        .join(F.broadcast(directory), "cell")
        .join(chains, ["key", "sha"], "left")
        .select("bucket", "depth", "key", "sha", "keep", "n", F.coalesce("place", F.lit(1)).alias("place"))
    )
    found = answer(keyed, index, ["key", "sha"], ["keep", "n", "place"], "n", total)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("place").alias("chain_place"),
    )


def keep_last_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of equal texts; of rows that repeat the kept id and text one stays."""
    found = settle(exact_dedup(docs, doc_id, text, **options))
    dropped = found.filter("not kept").select("doc_id", "text_sha256").distinct()
    again = found.filter("kept and group_size > 1").groupBy("doc_id", "text_sha256").count().filter("count > 1")
    keys = [F.col(doc_id), F.sha2(lower_ascii(F.col(text)).cast("binary"), 256)]
    return without(docs, keys, dropped, once=not again.isEmpty())


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
