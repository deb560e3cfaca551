"""Dates and timestamps in several written forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The written forms accepted, in order.
DATE_FORMS = ("dd/MM/yyyy", "yyyy-MM-dd")
TIME_FORMS = ("HH:mm", "HH:mm:ss")
TIMESTAMP_FORMS = tuple(f"{date} {time}" for time in TIME_FORMS for date in DATE_FORMS)


def _has_shape(value: Column, form: str) -> Column:
    """Whether a text has the length of a form and its first separator in the same place."""
    place = next(i for i, mark in enumerate(form) if not mark.isalpha())
    return (F.length(value) == len(form)) & (F.substring(value, place + 1, 1) == form[place])


def _routed(value: Column, forms: Sequence[str], parse: Callable[[Column, str], Column]) -> Column:
    # A failed parse costs an exception per row. All forms have fixed widths, so the shape of a text names the
    # only one it can match: each row is parsed once instead of falling through the list.
    result = None
    for form in forms:
        result = (F if result is None else result).when(_has_shape(value, form), parse(value, form))
    return result


def parse_date(value: Column, forms: Sequence[str] = DATE_FORMS) -> Column:
    return _routed(value, forms, lambda text, form: F.try_to_date(text, form))


def parse_timestamp(date: Column, time: Column, forms: Sequence[str] = TIMESTAMP_FORMS) -> Column:
    """Timestamp in the session zone from a date text and a time text; null if either is missing."""
    joined = F.concat_ws(" ", date, time)
    return _routed(joined, forms, lambda text, form: F.try_to_timestamp(text, F.lit(form)))


def load_day(value: Column) -> Column:
    """The date of a load from its ``yyyy-MM-dd`` text."""
    return F.try_to_date(value, DATE_FORMS[1])
