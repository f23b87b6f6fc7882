"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Forms of dates other than ISO that a column may be written in, the likelier reading first.
DATE_FORMS = (
    "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "yyyyMMdd", "d.M.yyyy", "M-d-yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "d MMMM yyyy", "d MMM yyyy",
)
# How far a scaled value may lie from a whole number: noise of binary fractions, absolute and relative.
NOISE, RELATIVE_NOISE = 1e-6, 1e-12


def share(part: Column, whole: Column, places: int = 3) -> Column:
    """``part / whole`` rounded half up; NULL when the whole is zero."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), places)


def positive_log10(c: Column) -> Column:
    """Base-10 logarithm; NULL at zero."""
    return F.log10(F.nullif(c, F.lit(0)))


def number_or_zero(c: Column) -> Column:
    """Value as a double; 0 where it is missing or not a number."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def date_or_null(c: Column, form: str | None = None) -> Column:
    """Date of a text in one of DATE_FORMS, else of an ISO date or timestamp; NULL where it cannot be read."""
    text = c.cast("string")
    return F.to_date(F.try_to_timestamp(text) if form is None else F.try_to_timestamp(F.trim(text), F.lit(form)))


def date_form(df: DataFrame, column: str) -> str | None:
    """The one form that reads most values of a column; None is ISO, which also wins ties.

    Other forms read none of the values that ISO does, so where ISO reads half of the values that aren't blank they are not
    tried. Among forms that read as many, as day and month first where no day is past 12, the earlier one is taken.
    """
    c = F.col(column)
    blank = F.trim(c.cast("string")) == ""
    seen = df.agg(F.count(date_or_null(c)).alias("iso"), F.count_if(~blank).alias("filled")).first()
    if 2 * seen["iso"] >= seen["filled"]:
        return None
    reads = [F.count_if(date_or_null(c).isNull() & ~blank & date_or_null(c, form).isNotNull()) for form in DATE_FORMS]
    row = df.agg(*[r.alias(f"f{i}") for i, r in enumerate(reads)]).first()
    best = max(range(len(DATE_FORMS)), key=lambda i: (row[f"f{i}"], -i))
    return DATE_FORMS[best] if row[f"f{best}"] > seen["iso"] else None


def whole_number(c: Column, kind: str) -> Column:
    """Integer of a number or its text, also written like ``1.0``; fails where it isn't whole or doesn't fit."""
    plain = c.cast("string").try_cast(kind)
    exact = c.cast("decimal(38,10)")
    failed = F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string")))
    # Most values are written as integers; decimals are only tried for the rest.
    return F.coalesce(plain, F.when(exact % 1 != 0, failed).otherwise(exact.cast(kind)))


class Metric:
    """Sum and mean of a metric, either as plain doubles or as exact fixed-point numbers.

    Double sums depend on the order in which partial results meet, so a rerun can differ in the last
    digit. With ``places`` set, values are added as integers of that many decimal places, which gives
    the same result on every run and every layout; a value with more places fails.
    """

    def __init__(self, places: int | None = None):
        self.scale = None if places is None else 10**places

    def total(self, c: Column) -> Column:
        if self.scale is None:
            return F.sum(c)
        return self._units(c) / F.lit(float(self.scale))

    def mean(self, c: Column) -> Column:
        if self.scale is None:
            return F.avg(c)
        return self._units(c) / F.nullif(F.count(c), F.lit(0)) / F.lit(float(self.scale))

    def _units(self, c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(self.scale))
        whole = F.rint(scaled)
        off = F.abs(scaled - whole) > F.greatest(F.lit(NOISE), F.abs(scaled) * F.lit(RELATIVE_NOISE))
        message = F.concat(F.lit("more decimal places than the sum keeps: "), c.cast("string"))
        return F.sum(F.when(off, F.raise_error(message)).otherwise(whole.cast("bigint"))).cast("double")
