"""Scalar column functions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them runs Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "canonical_text", "surrogate_key", "iff", "code_map", "safe_divide", "round_half_up",
    "float_to_int", "cast", "safe_cast", "bool_to_text", "concat_strict", "length", "position",
    "replace", "right", "split_part", "hash_text", "null_safe_eq", "scd_hash", "array_construct",
    "array_append", "array_concat", "PAYMENT_METHODS", "RATE_TYPES", "payment_method", "rate_type",
]

# Payment code -> label (else 'Unmapped').
PAYMENT_METHODS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip"}
# Rate code -> label (else 'Unknown').
RATE_TYPES = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau/Westchester", 5: "Negotiated", 6: "Group ride"}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_text(c: str | Column, kind: str = "auto") -> Column:
    """Text form used inside hashes: fixed, engine-independent formats.

    timestamps -> ``yyyy-MM-dd HH:mm:ss.SSS``; amounts -> 2-decimal fixed point (half-up);
    everything else -> plain string cast.  NULL stays NULL.
    """
    c = col_of(c)
    if kind == "timestamp":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
    if kind == "amount":
        # out-of-range amounts give NULL (a NULL key the not_null test reports), never an abort
        return c.try_cast("decimal(38,2)").cast("string")
    return c.cast("string")


def surrogate_key(*parts: tuple[str | Column, str] | str | Column) -> Column:
    """md5 over ``part1|part2|...``; NULL if any part is NULL (``||`` semantics).

    Each part is a column or ``(column, kind)`` with kind in
    ``auto/timestamp/amount`` (see :func:`canonical_text`).
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        c, kind = p if isinstance(p, tuple) else (p, "auto")
        if i:
            pieces.append(F.lit("|"))
        pieces.append(canonical_text(c, kind))
    return F.md5(F.concat(*pieces))


def iff(cond: Column, a, b) -> Column:
    """``iff(cond, a, b)``: a NULL condition takes ``b``."""
    return F.when(cond, a).otherwise(b)


def code_map(c: str | Column, mapping: Mapping, default) -> Column:
    """Simple CASE over literal codes; NULL or unknown code -> ``default``."""
    c = col_of(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def payment_method(c: str | Column) -> Column:
    return code_map(c, PAYMENT_METHODS, "Unmapped")


def rate_type(c: str | Column) -> Column:
    return code_map(c, RATE_TYPES, "Unknown")


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` -- zero denominator gives NULL, never an ANSI error."""
    return col_of(num) / F.nullif(col_of(den), F.lit(0))


def round_half_up(c: str | Column, scale: int = 0) -> Column:
    return F.round(col_of(c), scale)


def float_to_int(c: str | Column) -> Column:
    """FLOAT -> INT the way the warehouse casts: round half away from zero (Spark's cast truncates)."""
    return F.round(col_of(c)).cast("int")


def cast(c: str | Column, to: str) -> Column:
    """Strict cast: raises on malformed input under ANSI mode."""
    return col_of(c).cast(to)


def safe_cast(c: str | Column, to: str) -> Column:
    """Cast that yields NULL on malformed input."""
    return col_of(c).try_cast(to)


def bool_to_text(c: str | Column) -> Column:
    return col_of(c).cast("string")


def concat_strict(*cols: str | Column) -> Column:
    """``a || b``: NULL if any part is NULL."""
    return F.concat(*[col_of(c) for c in cols])


def length(c: str | Column) -> Column:
    return F.length(col_of(c))


def position(substr: str | Column, s: str | Column) -> Column:
    """1-based position of ``substr`` in ``s``; 0 if absent."""
    sub = F.lit(substr) if isinstance(substr, str) else substr
    return F.position(sub, col_of(s))


def replace(s: str | Column, old: str, new: str) -> Column:
    """Replace every literal occurrence of ``old``."""
    return F.replace(col_of(s), F.lit(old), F.lit(new))


def right(s: str | Column, n: int | Column) -> Column:
    """Last ``n`` characters; ``n = 0`` gives ''."""
    return F.right(col_of(s), F.lit(n) if isinstance(n, int) else n)


def split_part(s: str | Column, delim: str, n: int | Column) -> Column:
    """Part ``n`` (1-based; negative counts from the end) of ``s`` split on the literal ``delim``."""
    return F.split_part(col_of(s), F.lit(delim), F.lit(n) if isinstance(n, int) else n)


def hash_text(c: str | Column) -> Column:
    """md5 of the text form; NULL -> NULL."""
    return F.md5(col_of(c).cast("string"))


def null_safe_eq(a: str | Column, b: str | Column, null_safe: bool = True) -> Column:
    return col_of(a).eqNullSafe(col_of(b)) if null_safe else (col_of(a) == col_of(b))


def scd_hash(*cols: str | Column) -> Column:
    """md5 of ``coalesce(cast(c as string), '')`` joined by ``|`` -- NULLs become ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols]))


def array_construct(*cols: str | Column) -> Column:
    return F.array(*[col_of(c) for c in cols])


def array_append(arr: str | Column, value) -> Column:
    return F.array_append(col_of(arr), value if isinstance(value, Column) else F.lit(value))


def array_concat(a: str | Column, b: str | Column) -> Column:
    return F.concat(col_of(a), col_of(b))

