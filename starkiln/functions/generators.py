"""Row generators: integer series, date spines, partition-date lists.

All of them produce distributed rows (``spark.range`` splits into as many
partitions as the cluster has cores) rather than building a list on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["generate_series", "date_spine", "date_partitions", "spine_between"]

_STEP = {"day": "DAY", "week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR",
         "hour": "HOUR", "minute": "MINUTE", "second": "SECOND"}


def generate_series(spark: SparkSession, n: int, name: str = "generated_number") -> DataFrame:
    """Integers 1..n in one column; error if n <= 0."""
    if n is None or n <= 0:
        raise ValueError("generate_series needs n >= 1")
    return spark.range(1, int(n) + 1).select(F.col("id").alias(name))


def _count_parts(part: str, start, end) -> int:
    """Number of ``part`` boundaries between two python dates/datetimes (end exclusive)."""
    if part in ("day", "week", "hour", "minute", "second"):
        secs = {"day": 86400, "week": 604800, "hour": 3600, "minute": 60, "second": 1}[part]
        a = dt.datetime.combine(start, dt.time()) if type(start) is dt.date else start
        b = dt.datetime.combine(end, dt.time()) if type(end) is dt.date else end
        return int((b - a).total_seconds() // secs)
    months = (end.year - start.year) * 12 + (end.month - start.month)
    return months // {"month": 1, "quarter": 3, "year": 12}[part]


def date_spine(spark: SparkSession, part: str, start, end, name: str | None = None) -> DataFrame:
    """One row per ``part`` from ``start`` (inclusive) to ``end`` (exclusive).

    Equal bounds give an empty frame.  Rows are generated by ``spark.range`` over
    offsets so the spine is split across tasks like any other scan.
    """
    part = part.lower()
    if part not in _STEP:
        raise ValueError(f"unsupported date part {part!r}")
    if isinstance(start, str):
        start = dt.date.fromisoformat(start) if len(start) <= 10 else dt.datetime.fromisoformat(start)
    if isinstance(end, str):
        end = dt.date.fromisoformat(end) if len(end) <= 10 else dt.datetime.fromisoformat(end)
    name = name or f"date_{part}"
    n = max(_count_parts(part, start, end) + 1, 0)
    def fixed(x):  # text, so that the driver host's time zone has no say in a timestamp
        return F.lit(x) if type(x) is dt.date else F.lit(x.isoformat(sep=" ")).cast("timestamp")

    base = fixed(start)
    out = spark.range(0, n).select(F.timestamp_add(_STEP[part], F.col("id").cast("int"), base).alias(name))
    if type(start) is dt.date and part in ("day", "week", "month", "quarter", "year"):
        out = out.select(F.col(name).cast("date").alias(name))
    return out.filter(F.col(name) < fixed(end))


def spine_between(spark: SparkSession, bounds: DataFrame, lo: str, hi: str, part: str = "day",
                  name: str | None = None) -> DataFrame:
    """Date spine whose bounds come from a one-row frame (e.g. ``agg(min, max)`` of a table).

    Only the two bound values reach the driver; the rows themselves are generated
    in parallel.  ``hi`` is exclusive.
    """
    row = bounds.select(F.col(lo).alias("lo"), F.col(hi).alias("hi")).first()
    if row is None or row["lo"] is None or row["hi"] is None:
        return spark.range(0).select(F.lit(None).cast("date").alias(name or f"date_{part}"))
    return date_spine(spark, part, row["lo"], row["hi"], name)


def date_partitions(spark: SparkSession, spec: str, in_fmt: str = "yyyy-MM-dd", out_fmt: str = "yyyyMMdd",
                    name: str = "partition") -> DataFrame:
    """Inclusive list of day strings from ``'start[,end]'``; error if malformed or reversed."""
    parts = [p.strip() for p in spec.split(",")]
    if len(parts) not in (1, 2) or not all(parts):
        raise ValueError(f"bad partition range {spec!r}; expected 'start[,end]'")
    py_fmt = in_fmt.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d")
    try:
        lo = dt.datetime.strptime(parts[0], py_fmt).date()
        hi = dt.datetime.strptime(parts[-1], py_fmt).date()
    except ValueError as e:
        raise ValueError(f"bad partition date in {spec!r}: {e}") from None
    if hi < lo:
        raise ValueError(f"partition range {spec!r} ends before it starts")
    days = date_spine(spark, "day", lo, hi + dt.timedelta(days=1), "d")
    return days.select(F.date_format("d", out_fmt).alias(name))
