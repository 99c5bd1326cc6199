"""Reading submissions and activity into typed, corrected, located records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.joins import COPIES, HOT_ROWS, attach_answers, fits, lookup_join
from ..sources.session import settle


def ingest_records(df: DataFrame, columns: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """Keep the listed columns and read the date columns as dates; bad text becomes null."""
    dates = set(date_cols)
    return df.select(*[F.col(c).try_cast("date").alias(c) if c in dates else F.col(c) for c in columns])


def remap_codes(df: DataFrame, code: str, xref: DataFrame, old: str, new: str) -> DataFrame:
    """Replace a code by its successor where one is listed.

    A code with several distinct successors gives one row per successor.
    """
    successors = xref.select(F.col(old).alias("_old"), F.col(new).alias("_new")).distinct()
    joined = lookup_join(df, successors, {code: "_old"})
    return joined.withColumn(code, F.coalesce("_new", code)).drop("_new")


def exclude_known_bad(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Drop rows that meet all conditions, under three-valued logic.

    A row with a null in one condition is dropped if the others hold. Apply it
    before codes are remapped: the conditions are about codes as submitted.
    """
    bad = reduce(lambda a, b: a & b, [F.col(c) == value for c, value in conditions.items()])
    return df.filter(~bad)


def waterfall_lookup(
    df: DataFrame, candidates: Sequence[str], ref: DataFrame, ref_key: str, out: str, source: DataFrame | None = None
) -> DataFrame:
    """First candidate code, in order, that the reference list knows; null if it knows none.

    The list should already be cut to entries in force. A code that many rows share,
    a placeholder the list does not know for example, is dealt over several tasks.
    ``source`` gives a written table whose rows ``df`` is made of: if the list is too
    large to be copied, each set of candidates in it is then looked up once, and the
    rows are joined with the answers once instead of once per candidate.
    """
    known = ref.select(F.col(ref_key).alias("_known")).filter(F.col("_known").isNotNull()).distinct()
    small = fits(known)
    found = [f"_found_{i}" for i in range(len(candidates))]

    def looked_up(rows: DataFrame) -> DataFrame:
        for candidate, name in zip(candidates, found):
            hit = known.withColumn(name, F.col("_known"))
            rows = lookup_join(rows, hit, {candidate: "_known"}, small=small, copies=COPIES)
        return rows.withColumn(out, F.coalesce(*found)).drop(*found)

    if small or source is None:
        return looked_up(df)
    # A set may hold nulls, which its keys tell from every code.
    keys = {f"_set_{i}": F.coalesce(F.concat(F.lit("="), c), F.lit("")) for i, c in enumerate(candidates)}
    sets = looked_up(source.groupBy(*candidates).agg(F.count(F.lit(1)).alias("_rows")))
    sets = sets.filter(F.col(out).isNotNull() | (F.col("_rows") >= HOT_ROWS))
    sets = settle(sets.select(*[k.alias(n) for n, k in keys.items()], "_rows", F.struct(out).alias("_answer")))
    return attach_answers(df.withColumns(keys), sets, list(keys), [out], hot_rows=HOT_ROWS).drop(*keys)


def first_event_per_key(df: DataFrame, org: str, key: str, date: str, since: str, out: str) -> DataFrame:
    """Earliest date on or after ``since`` for each organisation and upper-cased key."""
    return (
        df.filter(F.col(date) >= F.lit(since).cast("date"))
        .groupBy(org, F.upper(key).alias(key))
        .agg(F.min(date).alias(out))
    )


def activity_extract(
    df: DataFrame, date: str, since: str, predicates: Sequence[Column] = ()
) -> DataFrame:
    """Rows on or after ``since`` that meet every predicate; both reach the file scan."""
    return reduce(
        lambda rows, test: rows.filter(test),
        predicates,
        df.filter(F.col(date) >= F.lit(since).cast("date")),
    )
