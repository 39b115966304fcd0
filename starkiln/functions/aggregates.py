"""Aggregate column functions (all partial-aggregation friendly except listagg)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col_of

__all__ = ["any_value", "bool_or", "listagg", "coalesce_max"]


def any_value(c: str | Column) -> Column:
    return F.any_value(col_of(c))


def bool_or(c: str | Column) -> Column:
    return F.bool_or(col_of(c))


def coalesce_max(c: str | Column, default) -> Column:
    """``coalesce(max(c), default)`` -- a global max that still yields a value on an empty input."""
    return F.coalesce(F.max(col_of(c)), default if isinstance(default, Column) else F.lit(default))


def listagg(measure: str, delimiter: str = ",", order_by: str | None = None, descending: bool = False) -> Column:
    """Concatenate a group's values with ``delimiter``, optionally ordered.

    ``measure`` and ``order_by`` are SQL expressions over the input columns.
    For the first-n form see :func:`starkiln.operators.aggregate.listagg_limited`,
    which limits rows per group before the shuffle.
    """
    d = delimiter.replace("'", "''")
    within = f" WITHIN GROUP (ORDER BY {order_by}{' DESC' if descending else ''})" if order_by else ""
    return F.expr(f"listagg(cast({measure} as string), '{d}'){within}")
