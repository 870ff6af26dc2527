"""Row filters of the reports. Each keeps the bare column on one side, so scans can prune."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import _col, instant


def between_instants(c, start, end) -> Column:
    """Closed range of instants."""
    return _col(c).between(instant(start), instant(end))


def last_24_hours(c, as_of) -> Column:
    """Closed range that ends at ``as_of`` and begins one day earlier."""
    end = instant(as_of)
    return _col(c).between(end - F.expr("interval 1 day"), end)


def in_year(c, year: int) -> Column:
    c = _col(c)
    return (c >= instant(f"{year:04d}-01-01")) & (c < instant(f"{year + 1:04d}-01-01"))


def text_between(c, low: str, high: str) -> Column:
    """Range of a text code, compared as text."""
    return _col(c).between(F.lit(low), F.lit(high))


def number_between(c, low: int, high: int) -> Column:
    """Range of a text code, compared as a number; text that is no number is left out."""
    return _col(c).try_cast("int").between(F.lit(low), F.lit(high))


def number_not_in(c, values) -> Column:
    """A text code, read as a number, that is none of ``values``."""
    return ~_col(c).try_cast("int").isin(*values)


def starts_with_any(c, prefixes) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | _col(c).startswith(prefix)
    return out
