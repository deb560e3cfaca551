"""Number parsing. Text that holds no readable number gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_long(value: Column) -> Column:
    return value.try_cast("bigint")


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_double(value: Column) -> Column:
    return value.try_cast("double")


def digits_to_int(value: Column) -> Column:
    """Keep digits and minus signs only, so a decimal point vanishes: ``10.5`` reads as 105."""
    return F.regexp_replace(value.cast("string"), "[^0-9-]", "").try_cast("int")


def decimal_text(value: Column) -> Column:
    """Read a number with ``,`` or ``.`` as decimal mark, ignoring any other characters."""
    pointed = F.replace(value.cast("string"), F.lit(","), F.lit("."))
    return F.regexp_replace(pointed, "[^0-9.-]", "").try_cast("double")


def percent_text(value: Column) -> Column:
    """Read a percentage on the 0..100 scale; the sign goes with the other non-numeric characters."""
    return decimal_text(value)


def decimal_text_to_int(value: Column) -> Column:
    """Read as a decimal, then drop the fraction."""
    return decimal_text(value).try_cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; null when either is null or ``whole`` is zero."""
    return F.try_divide(part, whole)
