"""Joins that stay even when one key holds a large share of the rows.

A lookup is broadcast only after its size has been measured. A lookup that is
too large goes through a shuffled join in which rows that cannot match are
spread over all tasks; Spark's adaptive skew splitting handles what remains.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType

from ..sources.session import bounded, rows_at_most, settle
from .columns import all_known

LOOKUP_ROWS = 50_000
"""Largest lookup, in rows, that is copied to every executor."""

HOT_ROWS = 1_000_000
"""Group size from which a group counts as hot."""

PRODUCT_ROWS = 20_000
"""Largest list, in rows, that is attached to every row as an array."""

_SPREAD = "_spread"
_PLACES = 32

COPIES = 32
"""Places that the rows of one key are dealt over, each with its own copy of the lookup's rows."""

KEY_CLASSES = 4096
"""Classes that keys are counted in by their digest, to tell whether any key is crowded."""


def key_class(key: str) -> Column:
    """Class of a key, null for a null key."""
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(KEY_CLASSES)).cast("int"))


def crowded_classes(*parts: tuple[DataFrame, str], rows: int = HOT_ROWS) -> list[int]:
    """Classes of keys that hold too many of the rows of all ``(frame, key)`` parts for one task.

    That is over ``rows`` and over four times their share, so they are a quarter of the
    classes at most. Counted in one job, in which only the counts are shuffled. The class
    of all null keys is -1.
    """
    seen = parts[0][0].select(key_class(parts[0][1]).alias("_class"))
    for df, key in parts[1:]:
        seen = seen.unionByName(df.select(key_class(key).alias("_class")))
    counts = seen.groupBy("_class").agg(F.count(F.lit(1)).alias("n"))
    counts = {-1 if r._class is None else r._class: r.n for r in counts.collect()}
    most = max(rows, 4 * sum(counts.values()) // KEY_CLASSES)
    return sorted(c for c, n in counts.items() if n > most)


def in_classes(key: str, classes: Sequence[int]) -> Column:
    """Whether the key's class is one of those."""
    return F.coalesce(key_class(key), F.lit(-1)).isin(list(classes))


def fits(df: DataFrame, rows: int = LOOKUP_ROWS) -> bool:
    """Whether a frame has at most ``rows`` rows.

    Known from writing it if it is settled; otherwise a job counts, up to ``rows + 1``.
    """
    most = rows_at_most(df)
    if most is not None and most <= rows:
        return True
    return not df.select(F.lit(1)).offset(rows).take(1)


def spread_left_join(
    df: DataFrame, other: DataFrame, keys: Sequence[str], idle: Column | None = None, copies: int = 1
) -> DataFrame:
    """Shuffled left join on same-named keys; rows that cannot match do not pile up.

    Rows with a null key, and rows for which ``idle`` holds, get a spread value
    that no row of ``other`` has. It is made of the row's partition number, so that
    copies of one row part too, and a hash of its values. A retried task reproduces
    both, so a lost executor cannot change the result. With ``copies`` the rows of
    every other key are dealt the same way over so many places, and ``other``, which
    should be narrow, is repeated in each: a key that most rows share, known to
    ``other`` or not, is then no single task's.
    """
    stuck = ~all_known([F.col(k) for k in keys])
    if idle is not None:
        stuck = stuck | F.coalesce(idle, F.lit(False))
    values = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    place = F.spark_partition_id() * _PLACES + F.pmod(F.hash(*values), F.lit(_PLACES)) + 1
    dealt = -F.pmod(place, F.lit(copies)) if copies > 1 else F.lit(0)
    spread = F.when(stuck, place).otherwise(dealt)
    places = F.explode(F.sequence(F.lit(1 - copies), F.lit(0))) if copies > 1 else F.lit(0)
    return (
        df.withColumn(_SPREAD, spread)
        .join(other.withColumn(_SPREAD, places), [*keys, _SPREAD], "left")
        .drop(_SPREAD)
    )


def join_within(df: DataFrame, other: DataFrame, keys: Sequence[str], within: str) -> DataFrame:
    """Left join on same-named ``keys`` and the column ``within``, in which both sides are dealt by ``keys`` alone.

    Joins on several such columns, or on none, then need no shuffle in between. For a
    column that has a few values per key: rows of a key are compared with each other.
    """
    theirs = {c: f"_their_{c}" for c in [*keys, within]}
    match = reduce(and_, [F.col(k) == F.col(theirs[k]) for k in keys])
    # Two bounds, as the rows would be dealt by an equality too.
    match = match & (F.col(within) >= F.col(theirs[within])) & (F.col(within) <= F.col(theirs[within]))
    return df.join(other.withColumnsRenamed(theirs), match, "left").drop(*theirs.values())


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    rows: int = LOOKUP_ROWS,
    small: bool | None = None,
    copies: int = 1,
    dealt: str | None = None,
) -> DataFrame:
    """Join a lookup on ``{column of df: key column of lookup}`` and drop the lookup's keys.

    Broadcast when the lookup is measured to be small, shuffled otherwise; a caller that
    joins one lookup several times measures it once and passes ``small``. Several
    lookup rows for one key fan the row out, as a join does. ``copies`` is for a shuffled
    left join whose rows may crowd on a few keys, see :func:`spread_left_join`. ``dealt``
    names the column of ``on`` that the rows are already dealt by: they stay where they are.
    """
    keys = [f"_key_{i}" for i in range(len(on))]
    other = bounded(lookup.withColumnsRenamed(dict(zip(on.values(), keys))), lookup)
    keyed = df.withColumns({k: F.col(c) for k, c in zip(keys, on)})
    if fits(lookup, rows) if small is None else small:
        joined = keyed.join(F.broadcast(other), keys, how)
    elif dealt is not None:
        joined = keyed.join(other.repartition(keys[list(on).index(dealt)]), keys, how)
    elif how == "left":
        joined = spread_left_join(keyed, other, keys, copies=copies)
    else:
        joined = keyed.join(other, keys, how)
    return joined.drop(*keys)


def attach_group_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: dict[str, Column],
    needed: Column,
    source: DataFrame | None = None,
    rows: int = LOOKUP_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Put aggregates of a row's group on the row, null where the group is not ``needed``.

    Stands in for a window over ``keys``, which would hold a whole group in one
    task. The groups are aggregated once, on both sides of their shuffle, and the
    needed and the hot ones are written down; that table is measured and joined back:
    broadcast if small, else by a shuffled join. For that join hot groups, if measured to
    be few, are answered from a broadcast and their rows are spread; adaptive skew
    splitting handles any others. A null key belongs to no group. ``source`` gives
    the rows to aggregate when ``df`` is they with columns added.
    """
    answer = F.struct(*[F.when(needed, F.col(n)).alias(n) for n in stats])
    groups = settle(
        (df if source is None else source)
        .filter(all_known([F.col(k) for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in stats.items()])
        .filter(needed | (F.col("_rows") >= hot_rows))
        .select(*keys, "_rows", answer.alias("_answer"))
    )
    return attach_answers(df, groups, keys, list(stats), rows, hot_rows)


def attach_answers(
    df: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    rows: int = LOOKUP_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Put the fields ``names`` of ``_answer`` on the rows of each group, null for other rows.

    ``groups`` is a written table with a row per group: its keys, ``_rows`` and ``_answer``.
    It must have all groups of ``hot_rows`` and more.
    """
    values = {n: F.col("_answer")[n] for n in names}
    if fits(groups, rows):
        return df.join(F.broadcast(groups), list(keys), "left").withColumns(values).drop("_rows", "_answer")

    hot = groups.filter(F.col("_rows") >= hot_rows).select(*keys, F.col("_answer").alias("_hot"))
    if not fits(hot, rows or LOOKUP_ROWS):
        return spread_left_join(df, groups.drop("_rows"), keys).withColumns(values).drop("_answer")
    cold = groups.filter(F.col("_rows") < hot_rows).drop("_rows")
    marked = df.join(F.broadcast(hot), list(keys), "left")
    joined = spread_left_join(marked, cold, keys, idle=F.col("_hot").isNotNull())
    found = {n: F.coalesce(F.col("_hot")[n], F.col("_answer")[n]) for n in names}
    return joined.withColumns(found).drop("_hot", "_answer")


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    """``df`` itself, or an error that names some keys which occur more than once.

    For dimensions and definitions: a doubled row there would inflate every count it joins.
    """
    doubled = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if doubled:
        raise ValueError(f"{name} repeats keys: " + "; ".join(str(r.asDict()) for r in doubled))
    return df


def product(df: DataFrame, items: DataFrame, rows: int = PRODUCT_ROWS, buckets: int = 64) -> DataFrame:
    """Every row of ``df`` with every row of ``items``, for results that are a full grid.

    A list measured to be short is attached to each row as one array and unpacked
    in place, so ``df`` is not shuffled. A long one is split over buckets, and
    each row of ``df`` visits every bucket.
    """
    if fits(items, rows):
        packed = items.agg(F.collect_list(F.struct(*items.columns)).alias("_items")).scalar()
        return df.withColumn("_items", packed).select(*df.columns, F.inline("_items"))
    visits = df.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    placed = items.withColumn("_bucket", F.pmod(F.hash(*items.columns), F.lit(buckets)))
    return visits.join(placed, "_bucket").drop("_bucket")
