"""Connected components by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.session import settle
from .common import answer, settle_sized


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Hang the neighbours of each node on its smallest one: all larger neighbours, or all smaller ones and itself."""
    if large:
        rows = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        rows = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    joined = answer(rows, least, ["u"], ["m"], "n", 2 * total)
    moved = joined.filter("v > u") if large else joined.unionByName(least.select("u", F.col("u").alias("v"), "m"))
    return settle_sized(moved.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), 2 * total)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); a component is named by its smallest node.

    Stops when a round leaves the edges as they were: every node then hangs on its
    component's smallest one. The number of rounds grows with the logarithm of the nodes.
    """
    now = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_ = (F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
    before = now.agg(*print_).first()
    while True:
        now = _star(_star(now, True, before[0]), False, 2 * before[0])
        after = now.agg(*print_).first()
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
