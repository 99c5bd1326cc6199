"""Column -> Column helpers; all stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def month_floor(date: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(date, "MM")


def period_month(label: Column) -> Column:
    """First day of the month named by a label that ends in ``MM-YYYY``, else null."""
    month = F.left(F.right(label, F.lit(7)), F.lit(2))
    return F.concat(F.right(label, F.lit(4)), F.lit("-"), month, F.lit("-01")).try_cast("date")


def all_known(columns: Iterable[Column]) -> Column:
    """True where no column is null."""
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def _choose(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    chosen = F
    for condition, label in cases:
        chosen = chosen.when(condition, label)
    return chosen.otherwise(default)


def code_label(code: Column, labels, default) -> Column:
    """Label of the first ``(codes, label)`` entry that lists the code."""
    return _choose([(code.isin(codes), label) for codes, label in labels], default)


def code_pair_label(first: Column, second: Column, labels, default=None) -> Column:
    """As :func:`code_label` for two codes; ``None`` in place of the second list means any."""
    return _choose(
        [
            (first.isin(a) if b is None else first.isin(a) & second.isin(b), label)
            for a, b, label in labels
        ],
        default,
    )


def band_label(value: Column, bands, default) -> Column:
    """Label of the ``(from, below, label)`` band that holds the value, read as a number."""
    number = value.try_cast("double")
    cases = []
    for low, below, label in bands:
        tests = []
        if low is not None:
            tests.append(number >= low)
        if below is not None:
            tests.append(number < below)
        cases.append((reduce(lambda a, b: a & b, tests), label))
    return _choose(cases, default)


def count_if(condition: Column) -> Column:
    """Rows of the group that meet the condition; 0 and not null when none does."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """Quotient, null for a zero denominator, rounded half up if asked."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return quotient if digits is None else F.round(quotient, digits)


def suppressed(count: Column, threshold: int = 5) -> Column:
    """True for a small positive count, which must not be shown."""
    return (count > 0) & (count < threshold)


def suppress_and_round(count: Column, threshold: int = 5, base: int = 5) -> Column:
    """Small positive counts become 0, others the nearest multiple of ``base``; null stays.

    The result is a bigint, so national totals cannot overflow.
    """
    nearest = (F.round(count / F.lit(float(base)), 0) * base).cast("bigint")
    return F.when(suppressed(count, threshold), F.lit(0).cast("bigint")).otherwise(nearest)


def suppressed_flag(count: Column, threshold: int = 5) -> Column:
    """1 where :func:`suppress_and_round` hides the count, else 0."""
    return F.when(suppressed(count, threshold), 1).otherwise(0)


def element_id(value: Column, width: int = 3) -> Column:
    """Element ids as zero-padded text, so that ``1``, ``'1'``, ``'1.0'``, ``'001'`` and ``'0001'`` agree."""
    text = F.trim(value.cast("string"))
    digits = F.regexp_extract(text, r"^\+?0*([0-9]+)(\.0*)?$", 1)
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.when(digits != "", padded).otherwise(text)
