"""Small pieces the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.joins import fits, spread_left_join
from ..sources.session import settle

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return."""

HOT_SHARE = 4096
"""A group with more than 1/4096 of all rows counts as hot, so there are at most 4096 hot groups."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data. Python workers of a local session get this package's folder on their path."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def answer(rows: DataFrame, groups: DataFrame, keys: Sequence[str], values: Sequence[str], size: str, total: int) -> DataFrame:
    """Put ``values`` of a row's group on each row, null where there is no such group.

    ``groups`` has one row per group with its row count in ``size``. Groups over
    1/HOT_SHARE of ``total`` rows (at most HOT_SHARE of them) come by broadcast; their
    rows are spread over the shuffled join that answers the others. Keys must not be null.
    """
    least = max(1000, total // HOT_SHARE)
    packed = groups.select(*keys, size, F.struct(*values).alias("_found"))
    hot = packed.filter(F.col(size) > least).select(*keys, F.col("_found").alias("_hot"))
    cold = packed.filter(F.col(size) <= least).select(*keys, F.col("_found").alias("_cold"))
    marked = rows.join(F.broadcast(hot), list(keys), "left")
    joined = spread_left_join(marked, cold, list(keys), idle=F.col("_hot").isNotNull())
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.withColumns({v: found[v] for v in values}).drop("_hot", "_cold")


def settle_sized(df: DataFrame, rows: int, per_file: int = 20_000) -> DataFrame:
    """Settle a result of at most ``rows`` rows in as many files as they need, not one per shuffle partition."""
    return settle(df.coalesce(max(1, -(-rows // per_file))))


def without(docs: DataFrame, keys: Sequence[Column], gone: DataFrame, rows: int = 500_000, once: bool = False) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are in ``gone``, which is broadcast if measured to be at most ``rows``.

    ``once`` also keeps only one row for equal keys. Null equals null. Helper columns
    get names that ``docs`` does not have.
    """
    stem = "_"
    while any(c.startswith(stem) for c in docs.columns):
        stem += "_"
    mine, theirs = [f"{stem}{i}" for i in range(len(keys))], [f"{stem}{i}gone" for i in range(len(keys))]
    other = gone.toDF(*theirs)
    other = F.broadcast(other) if fits(other, rows) else other
    same = F.lit(True)
    for a, b in zip(mine, theirs):
        same = same & F.col(a).eqNullSafe(F.col(b))
    left = docs.withColumns(dict(zip(mine, keys))).join(other, same, "left_anti")
    return (left.dropDuplicates(mine) if once else left).drop(*mine)


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary column into stretches of about ``limit`` bytes.

    Yields (first row, end row, bytes of the stretch, offsets into them). A text
    longer than the limit is a stretch of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
