"""Join helpers: plain equi-joins.

Nothing here decides how a join runs: Spark broadcasts a side whose size is below its
threshold (file sizes when planning, measured shuffle sizes at run time) and otherwise
shuffles, where adaptive execution splits hot keys.  Nothing is cached, so a lookup that
has changed on disk is seen by the next query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def key_condition(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                  null_safe: bool = False) -> Column:
    cond = None
    for a, b in zip(left_keys, right_keys):
        c = left[a].eqNullSafe(right[b]) if null_safe else (left[a] == right[b])
        cond = c if cond is None else cond & c
    return cond


def orphans(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
            parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti join; duplicates kept)."""
    ck = _keys(child_key)
    pk = _keys(parent_key) if parent_key is not None else ck
    not_null = None
    for k in ck:
        not_null = F.col(k).isNotNull() if not_null is None else not_null & F.col(k).isNotNull()
    c = child.filter(not_null)
    p = parent.select(*[F.col(a).alias(f"__pk{i}") for i, a in enumerate(pk)])
    cond = key_condition(c, p, ck, [f"__pk{i}" for i in range(len(pk))])
    return c.join(p, cond, "left_anti")


def semi(df: DataFrame, keys_df: DataFrame, keys: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key tuple is in ``keys_df`` (``IN (select distinct ...)``)."""
    ks = _keys(keys)
    k = keys_df.select(*[F.col(x).alias(f"__k{i}") for i, x in enumerate(ks)]).distinct()
    return df.join(k, key_condition(df, k, ks, [f"__k{i}" for i in range(len(ks))], null_safe), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key tuple is not in ``keys_df``; with plain ``=`` a NULL key is always kept."""
    ks = _keys(keys)
    k = keys_df.select(*[F.col(x).alias(f"__k{i}") for i, x in enumerate(ks)]).distinct()
    return df.join(k, key_condition(df, k, ks, [f"__k{i}" for i in range(len(ks))], null_safe), "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join with ``<=>`` so NULL keys match each other."""
    ks = _keys(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in ks], *[c for c in right.columns if c not in ks])
    out = left.join(r, key_condition(left, r, ks, [f"__r_{k}" for k in ks], null_safe=True), how)
    return out.drop(*[f"__r_{k}" for k in ks])
