"""Row filters and one-pass filter diagnostics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def in_window(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Half-open window ``lo <= ts < hi`` (literal bounds push down to the scan)."""
    return df.filter((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)))


def latest_batch(df: DataFrame, part: str = "_source_file", ts: str = "_loaded_at") -> DataFrame:
    """Keep the rows whose ``ts`` equals the max ``ts`` of their ``part`` (latest batch wins).

    Equivalent to ``max(ts) over (partition by part)`` + filter, planned without a
    window: the per-file max is a partial aggregate (one row per file and task before the
    shuffle) and a semi join brings it back, so no task has to sort a hot file.
    """
    latest = df.groupBy(part).agg(F.max(ts).alias("__max_ts"))
    # PARTITION BY groups NULL file names together, so the file key compares NULL-safely
    cond = df[part].eqNullSafe(latest[part]) & (df[ts] == latest["__max_ts"])
    return df.join(latest, cond, "left_semi")


def literal_of(text: str, kind: T.DataType) -> Column:
    """A date or time given as text, as a literal of a column's own type.  Text never passes
    through the driver host's time zone, as a Python datetime would."""
    return F.lit(text).cast(kind)


def watermark_value(target: DataFrame | None, col: str = "_loaded_at", default: str = "1900-01-01",
                    kind: T.DataType | None = None) -> Column:
    """``coalesce(max(col), default)`` of the target as a literal of the column's type (one row
    reaches the driver: as microseconds for a timestamp, else as text)."""
    kind = kind or (target.schema[col].dataType if target is not None else T.TimestampType())
    if target is None:
        return literal_of(default, kind)
    top = F.max(col)
    v = target.agg((F.unix_micros(top) if isinstance(kind, T.TimestampType) else top.cast("string")).alias("m")).first()["m"]
    if v is None:
        return literal_of(default, kind)
    return F.timestamp_micros(F.lit(v)) if isinstance(kind, T.TimestampType) else literal_of(v, kind)


def since_watermark(src: DataFrame, target: DataFrame | None, col: str = "_loaded_at",
                    default: str = "1900-01-01", per_part: str | None = None) -> DataFrame:
    """Rows of ``src`` newer than the target.

    Default (``per_part=None``): strictly greater than the target's global max,
    or than ``default`` when the target is empty.  The max is resolved first and
    enters the plan as a literal, so it reaches the Parquet scan as a pushed
    filter.  ``per_part='_source_file'`` instead compares against each file's own
    max, so a batch committed late with an older timestamp is not skipped.
    """
    if per_part is None:
        kind = src.schema[col].dataType if target is None else None
        return src.filter(F.col(col) > watermark_value(target, col, default, kind))
    if target is None:
        return src
    seen = target.groupBy(per_part).agg(F.max(col).alias("__wm"))
    # NULL files are one part, as GROUP BY has them
    j = src.join(seen, src[per_part].eqNullSafe(seen[per_part]), "left")
    return j.filter(seen["__wm"].isNull() | (src[col] > seen["__wm"])).select(src["*"])


def filter_audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One pass over ``df``: rows failing each rule (overlapping), plus total/kept/dropped and %.

    A row fails a rule when the predicate is false *or* NULL (WHERE semantics).
    Output: ``(rule, n_rows, pct_of_total)``.
    """
    aggs = [F.count(F.lit(1)).alias("total")]
    keep = None
    for name, pred in rules.items():
        ok = F.coalesce(pred, F.lit(False))
        aggs.append(F.sum(F.when(~ok, 1).otherwise(0)).alias(f"r_{name}"))
        keep = ok if keep is None else keep & ok
    aggs.append(F.sum(F.when(keep, 1).otherwise(0)).alias("kept"))
    one = df.agg(*aggs)
    names = ["total", "kept"] + [f"r_{n}" for n in rules]
    stack = ", ".join(f"'{n[2:] if n.startswith('r_') else n}', cast({n} as bigint)" for n in names)
    long = one.selectExpr("total as __total", "kept as __kept", f"stack({len(names)}, {stack}) as (rule, n_rows)")
    dropped = one.select(F.lit("dropped").alias("rule"), (F.col("total") - F.col("kept")).cast("bigint").alias("n_rows"),
                         F.col("total").alias("__total"))
    both = long.select("rule", "n_rows", "__total").unionByName(dropped)
    return both.select("rule", "n_rows",
                       F.round(F.try_divide(F.col("n_rows") * 100.0, F.col("__total")).cast("double"), 1)
                       .alias("pct_of_total"))


def minmax_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``<col>_min`` and ``<col>_max`` for every column (single scan)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def scoped(df: DataFrame, where: str | Column | None) -> DataFrame:
    """Optional ``where`` scoping of a tested relation."""
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


def preview(df: DataFrame, n: int = 1000, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; with an order this is a top-k (TakeOrderedAndProject), not a full sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
