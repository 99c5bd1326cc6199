"""Mix sources to target weights with DataFrame functions alone.

Every document gets a hash-random key. Within a source the documents are ranged by that
key; sums per range give each range its offset, and a running sum inside the range does
the rest, so a source's prefix sums need no task that sees the whole source. A source's
budget is cut exactly: whole passes first, then the documents up to the budget's last word.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..sources.session import settle
from .common import WORD

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
RANGE_ROWS = 2_000
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share``
    of all sizes. A target stops at ``most`` times its source; the excess goes to the
    others by weight until none is above. That is one level: sources are filled in the
    order of limit over weight, and the level is what is left over the weight left. One
    row per source is all that is brought together here.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(named)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place - 1) % len(weights) + 1)
    limit = F.col("source_size") * most
    ranked = sources.withColumn("weight", weight).withColumn("fills", limit / F.col("weight"))
    filled = Window.orderBy("fills", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = ranked.withColumn("level", left / weight_left).withColumn("place", F.row_number().over(filled))
    open_place = F.min(F.when(F.col("fills") > F.col("level"), F.col("place"))).over(everything)
    first = leveled.withColumn("open", open_place)
    level = F.max(F.when(F.col("place") == F.col("open"), F.col("level"))).over(everything)
    capped = F.col("open").isNull() | (F.col("place") < F.col("open"))
    return first.withColumn("full_level", level).select(
        "source", "source_size", F.when(capped, limit.cast("double")).otherwise(F.col("full_level") * F.col("weight")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``.

    ``size`` is the number of words, 0 for null. ``taken`` counts the words the mix takes
    of a document, repeats included, never over ``most`` times its size. Null is a source
    of its own. The order is md5 of id and seed, so reruns agree; rows that repeat an
    id follow each other, and rows that repeat id and size are alike. The document on a
    budget's edge is cut inside. Sources without words get target 0. Empty in, empty out.
    """
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    sized = settle(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), key.alias("key")))
    bits = min(20, max(0, math.ceil(math.log2(max(1, sized.count()) / range_rows))))
    start = F.shiftright(F.conv(F.substring("key", 1, 5), 16, 10).cast("int"), 20 - bits)
    keys = {"named": F.coalesce("source", F.lit("")), "unnamed": F.col("source").isNull(), "range": start}
    placed = sized.withColumns(keys)

    ranges = settle(placed.groupBy(*keys).agg(F.sum("size").alias("size"), F.max("source").alias("source")))
    targets = source_targets(ranges, weights, share, most).select(
        F.coalesce("source", F.lit("")).alias("named"), F.col("source").isNull().alias("unnamed"), "source_size", "target"
    )
    earlier = Window.partitionBy("named", "unnamed").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("size").over(earlier), F.lit(0))).drop("size", "source")
    budgets = offsets.join(targets, ["named", "unnamed"])

    inside = Window.partitionBy(*keys).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(budgets, list(keys))
    return summed.select("doc_id", "source", "size", "source_size", "target", _taken(F.floor("target")).alias("taken"))


def _taken(budget: Column) -> Column:
    """Whole passes and the part of the last pass that falls to a document."""
    size, total = F.col("size"), F.greatest(F.col("source_size"), F.lit(1))
    passes = F.floor(budget / total)
    left = budget - passes * total - F.col("offset") - F.col("ahead")
    return (passes * size + F.greatest(F.lit(0), F.least(size, left))).cast("long")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS shuffled
  FROM documents
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 2 * source_size / weight AS fills,
         (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
  SELECT *, row_number() OVER (ORDER BY fills, source NULLS LAST) AS place FROM filled
), cut AS (
  SELECT min(place) AS place FROM leveled WHERE fills > level
), targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN c.place IS NULL OR l.place < c.place THEN 2.0 * l.source_size
              ELSE l.weight * (SELECT level FROM leveled WHERE place = c.place) END AS target
  FROM leveled l, cut c
), summed AS (
  SELECT s.*, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (floor(floor(target) / greatest(source_size, 1)) * size
        + greatest(0, least(size, floor(target) - floor(floor(target) / greatest(source_size, 1)) * greatest(source_size, 1) - ahead)))::BIGINT AS taken
FROM summed
"""
