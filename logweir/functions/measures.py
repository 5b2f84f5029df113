"""Column expressions over parsed fields and over counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.schemas import ERROR_STATUSES, PATH_DISPLAY


def is_error(status_code: Column) -> Column:
    return status_code.between(*ERROR_STATUSES)


def error_rate(errors: Column, total: Column) -> Column:
    """Share of errors, 0..1; 0 for an empty total (dividing by it would throw)."""
    return F.when(total > 0, errors.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def percentage(part: Column, total: Column) -> Column:
    return F.when(total > 0, F.lit(100.0) * part / total).otherwise(F.lit(0.0))


def as_percent(rate: Column) -> Column:
    return rate * F.lit(100.0)


def shorten_path(path: Column) -> Column:
    longest, kept = PATH_DISPLAY
    return F.when(
        F.length(path) > longest, F.concat(F.substring(path, 1, kept), F.lit("..."))
    ).otherwise(path)


def coerce_long(text: Column) -> Column:
    """Text of a number as a long without its fraction; anything else 0."""
    whole = text.try_cast("bigint")
    number = text.try_cast("double")
    fits = F.abs(number) < F.lit(2.0**63)
    fraction = F.when(fits & ~text.rlike(r"^[+-]?\d+\z"), truncate(number))
    return F.coalesce(whole, fraction, F.lit(0).cast("bigint"))


def coerce_double(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def truncate(number: Column) -> Column:
    """A double as a long towards zero, held at the ends of the long range."""
    return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
