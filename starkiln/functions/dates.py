"""Date and time column functions with warehouse-compatible semantics.

``datediff`` counts *boundaries* crossed (31 Dec -> 1 Jan is one year,
00:00:00.9 -> 00:00:01.1 is one second), unlike ``timestampdiff`` which counts
whole elapsed units.  Weekday numbering follows Spark (1 = Sunday).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_of

__all__ = [
    "seconds_between", "datediff", "dateadd", "date_trunc", "last_day", "make_date", "to_date",
    "hour", "dayname", "is_weekend", "micros_to_ntz", "current_timestamp_utc", "current_timestamp_ntz",
]

_PARTS = {
    "microsecond": "MICROSECOND", "millisecond": "MILLISECOND", "second": "SECOND", "minute": "MINUTE",
    "hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR",
}


def _part(part: str) -> str:
    p = part.lower().rstrip("s")
    if p not in _PARTS:
        raise ValueError(f"unsupported date part {part!r}")
    return p


def _as_ts(c: Column) -> Column:
    # NTZ and LTZ both map onto the UTC session clock here.
    return c.cast("timestamp")


def _div(a: Column, n: int) -> Column:
    """Integer quotient, rounded down (a double would lose microseconds of far dates)."""
    return F.call_function("div", a - F.pmod(a, F.lit(n)), F.lit(n))


def _floor_units(c: Column, micros_per_unit: int) -> Column:
    return _div(F.unix_micros(_as_ts(c)), micros_per_unit)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Second boundaries between two timestamps (bigint)."""
    return F.unix_timestamp(_as_ts(col_of(end))) - F.unix_timestamp(_as_ts(col_of(start)))


def datediff(part: str, start: str | Column, end: str | Column) -> Column:
    """Boundary count of ``part`` between ``start`` and ``end`` (end - start)."""
    a, b = col_of(start), col_of(end)
    p = _part(part)
    if p == "second":
        return seconds_between(a, b)
    if p in ("microsecond", "millisecond", "minute", "hour"):
        unit = {"microsecond": 1, "millisecond": 1_000, "minute": 60_000_000, "hour": 3_600_000_000}[p]
        return (_floor_units(b, unit) - _floor_units(a, unit)).cast("bigint")
    if p == "day":
        return F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    if p == "week":
        wa, wb = F.date_trunc("week", _as_ts(a)), F.date_trunc("week", _as_ts(b))
        return _div(F.datediff(F.to_date(wb), F.to_date(wa)).cast("bigint"), 7)
    if p == "month":
        return ((F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))).cast("bigint")
    if p == "quarter":
        return ((F.year(b) * 4 + F.quarter(b)) - (F.year(a) * 4 + F.quarter(a))).cast("bigint")
    return (F.year(b) - F.year(a)).cast("bigint")


def dateadd(part: str, n: int | Column, c: str | Column) -> Column:
    """Add ``n`` parts; month arithmetic clamps to month end (Jan 31 + 1 month = Feb 29/28).
    A naive timestamp stays naive, and a date stays a date for parts of a day or more."""
    p = _part(part)
    n = (F.lit(n) if isinstance(n, int) else n).cast("int")
    c = col_of(c)
    months = {"month": 1, "quarter": 3, "year": 12}.get(p)
    if months:
        return c + F.make_ym_interval(F.lit(0), n * months)
    if p in ("day", "week"):
        return c + F.make_dt_interval(n * (7 if p == "week" else 1)).cast("interval day")
    return F.timestamp_add(_PARTS[p], n, c)


def date_trunc(part: str, c: str | Column) -> Column:
    """Start of the part, in the type of ``c`` for timestamps with and without a zone."""
    c = col_of(c)
    zoned = _as_ts(c)
    return c - (zoned - F.date_trunc(_PARTS[_part(part)].lower(), zoned))


def last_day(c: str | Column, part: str = "month") -> Column:
    """Last day of the week/month/quarter/year containing ``c``, as a date."""
    p = _part(part)
    c = col_of(c)
    if p == "month":
        return F.last_day(c)
    start = F.to_date(F.date_trunc(p, c))
    if p == "week":
        return F.date_add(start, 6)
    months = {"quarter": 3, "year": 12}[p]
    return F.date_sub(F.add_months(start, months), 1)


def make_date(y, m, d) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, int) else col_of(v)
    return F.make_date(lit(y), lit(m), lit(d))


def to_date(c: str | Column) -> Column:
    return F.to_date(col_of(c))


def hour(c: str | Column) -> Column:
    return F.hour(col_of(c))


def dayname(c: str | Column) -> Column:
    """Three-letter day name (``Sat``)."""
    return F.dayname(col_of(c))


def is_weekend(c: str | Column) -> Column:
    """Saturday or Sunday; NULL timestamp -> false (``iff`` semantics)."""
    return F.coalesce(F.dayofweek(col_of(c)).isin(1, 7), F.lit(False))


def micros_to_ntz(c: str | Column) -> Column:
    """Epoch microseconds (integer) -> naive timestamp."""
    return F.timestamp_micros(col_of(c).cast("bigint")).cast("timestamp_ntz")


def current_timestamp_utc() -> Column:
    return F.current_timestamp()


def current_timestamp_ntz() -> Column:
    """Naive snapshot time in UTC."""
    return F.localtimestamp()
