"""Predicates, safe casts, standardisation and exact sums as plain columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as they must be written where a dot or a backtick in them would mean something."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def is_present(name: str) -> Column:
    """Not null and not only spaces."""
    return F.coalesce(F.length(F.trim(F.col(name))) > 0, F.lit(False))


def within(actual: Column, expected: Column, tolerance: float) -> Column:
    return F.abs(actual - expected) <= F.lit(tolerance)


def standardise(name: str, spellings: Mapping[str, str]) -> Column:
    """Known spellings (any case, outer spaces ignored) become their code; others are upper-cased."""
    if not spellings:
        return F.upper(F.col(name))
    pairs = [F.lit(part) for item in spellings.items() for part in item]
    known = F.try_element_at(F.create_map(*pairs), F.lower(F.trim(F.col(name))))
    return F.coalesce(known, F.upper(F.col(name)))


def day_key(name: str) -> Column:
    """A date as the integer yyyymmdd."""
    day = F.col(name)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def exact_sum(name: str, places: int = 2) -> Column:
    """Sum of a double column, rounded half away from zero, that does not depend on the order of the rows.

    A double counts as the shortest decimal that reads as it, to 20 places. Whole parts and fractions
    are summed apart, so nothing is rounded to ``places`` before the end and no size of value is
    treated apart. A value or a sum of 38 digits or more before the point fails the job. NaN and
    infinity make the sum what they make of any sum.
    """
    value = F.col(name)
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    # Too many digits must stop the job in any ANSI setting.
    too_large = F.raise_error(F.concat(F.lit(f"{name} does not fit an exact sum: "), value.cast("string")))
    fits = F.when(~odd & (F.abs(value) >= 1e37), too_large.cast("double")).when(~odd, value)
    # From 2**53 on a double has no fraction.
    small = F.abs(fits) < float(1 << 53)
    digits = F.when(small, fits).cast("decimal(38,20)")
    whole_part = F.when(digits < 0, F.ceil(digits)).otherwise(F.floor(digits)).cast("decimal(38,0)")
    whole = F.sum(F.when(small, whole_part).otherwise(fits.cast("decimal(38,0)")))
    part = F.sum(F.coalesce((digits - whole_part.cast("decimal(18,0)")).cast("decimal(22,20)"), F.lit(0)))
    # The fractions' own whole part moves over, so 0 <= rest < 1 and the sign is that of units.
    units = whole + F.floor(part).cast("decimal(38,0)")
    rest = (part - F.floor(part)).cast("decimal(22,20)")
    rounded = F.when(units >= 0, units.cast("double") + F.round(rest, places).cast("double")).otherwise(
        -((-units - 1).cast("double") + F.round(1 - rest, places).cast("double"))
    )
    return F.coalesce(F.sum(F.when(odd, value)), F.round(rounded, places))
