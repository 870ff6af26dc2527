"""Column expressions shared by the reports.

Hospital timestamps carry no zone, so everything here works on
``timestamp_ntz``: results do not depend on the session zone, and a bound
written as a plain literal still reaches the parquet reader.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from .codes import AREA_MARKERS

# What counts as blank at the ends of an area name.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(value) -> Column:
    """A zone-less instant from a datetime, a date, ``'yyyy-M-d[ HH:mm:ss]'`` or a column."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, date):
        value = value.isoformat()
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def parse_dmy(text) -> Column:
    """Read ``d/M/yyyy HH:mm:ss`` text."""
    return F.to_timestamp_ntz(_col(text), F.lit("d/M/yyyy HH:mm:ss"))


def parse_ymd(text) -> Column:
    """Read ``yyyy-M-d HH:mm:ss`` text, with or without leading zeros."""
    return F.to_timestamp_ntz(_col(text), F.lit("yyyy-M-d HH:mm:ss"))


class DayBounds(NamedTuple):
    yesterday_start: Column
    yesterday_end: Column
    today_start: Column
    today_end: Column


def day_bounds(as_of) -> DayBounds:
    """First and last second of the day of ``as_of`` and of the day before."""
    today = instant(as_of).cast("date").cast("timestamp_ntz")
    day, last = F.expr("interval 1 day"), F.expr("interval '23:59:59' hour to second")
    return DayBounds(today - day, today - day + last, today, today + last)


def date_text(c) -> Column:
    return F.date_format(_col(c), "dd/MM/yyyy")


def stamp_text(c, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    return F.date_format(_col(c), pattern)


def site_short_name(name) -> Column:
    """``'01 - NORTH'`` becomes ``'NORTH'``: what follows the dash and one more character.

    The start counts back from the end; without a dash only the first
    character goes, and a dash within the last two leaves the name whole.
    """
    c = _col(name)
    return F.substr(c, F.instr(c, "-") - F.length(c) + 1)


def truncate(c, places: int = 0) -> Column:
    """Cut a decimal towards zero."""
    c, n = _col(c), F.lit(places)
    return F.when(c < 0, F.ceil(c, n)).otherwise(F.floor(c, n))


def percent(part, whole) -> Column:
    """100 * part / whole for counts, cut to two places, in whole numbers up to the last step."""
    hundredths = F.call_function("div", F.lit(10000).cast("bigint") * _col(part), _col(whole))
    return (hundredths.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def whole_days(start, end) -> Column:
    """Complete 24 hour days between two instants, cut towards zero."""
    return F.extract(F.lit("DAY"), _col(end) - _col(start)).cast("bigint")


def elapsed_days(start, end) -> Column:
    """Days between two instants with their fraction, as a decimal."""
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(18,6)")
    return seconds / F.lit(86400)


def rounded_days(start, end) -> Column:
    """Elapsed days rounded half away from zero."""
    return F.round(elapsed_days(start, end), 0).cast("bigint")


def round_hundred(c) -> Column:
    return F.round(_col(c), -2)


def concat_text(*parts) -> Column:
    """Join texts, taking NULL as no text."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def null_text() -> Column:
    """The blank column of a report: empty text and NULL are the same to the source."""
    return F.lit(None).cast("string")


def decode(c, labels: dict, default: Column | None = None) -> Column:
    """Label of a code; codes outside ``labels`` give ``default``, NULL unless given."""
    c = _col(c)
    out = None
    for code, label in labels.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return out if default is None else out.otherwise(default)


def text_if_null(c, missing: str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(missing))


def label_by_null(c, missing: str, present: str) -> Column:
    return F.when(_col(c).isNull(), missing).otherwise(present)


def normalize_area(name) -> Column:
    """Short form of an area name.

    The first marker found decides. A name that begins with it loses the
    marker, the character behind it and the word that follows; a name that
    holds it further on keeps what stands before it, less one character.
    A name without a marker stays as it is.
    """
    c = _col(name)
    out = None
    for marker in AREA_MARKERS:
        at = F.instr(c, marker)
        rest = F.substr(c, F.lit(len(marker) + 2))
        blank = F.instr(rest, " ")
        leading = F.when(blank > 0, F.btrim(F.substr(rest, blank + 1), F.lit(BLANKS)))
        short = F.when(at == 1, leading).otherwise(
            F.btrim(F.substr(c, F.lit(1), at - 2), F.lit(BLANKS))
        )
        out = F.when(at > 0, short) if out is None else out.when(at > 0, short)
    return out.otherwise(c)
