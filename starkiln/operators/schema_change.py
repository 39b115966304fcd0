"""Schema evolution of incremental targets: ignore / append_new_columns / sync_all_columns / fail."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("ignore", "append_new_columns", "sync_all_columns", "fail")

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def widens(src: T.DataType, dst: T.DataType) -> bool:
    """True if values of ``src`` fit ``dst`` without loss (a widening is not a schema change)."""
    if src == dst:
        return True
    if type(src) in _INT_RANK and type(dst) in _INT_RANK:
        return _INT_RANK[type(src)] <= _INT_RANK[type(dst)]
    if isinstance(src, T.FloatType) and isinstance(dst, T.DoubleType):
        return True
    if isinstance(src, T.DecimalType) and isinstance(dst, T.DecimalType):
        return src.scale <= dst.scale and (src.precision - src.scale) <= (dst.precision - dst.scale)
    if isinstance(src, T.StringType) and isinstance(dst, T.StringType):
        return True
    return False


@dataclass
class SchemaDiff:
    added: list[str] = field(default_factory=list)      # in delta, not in target
    removed: list[str] = field(default_factory=list)    # in target, not in delta
    changed: list[tuple[str, str, str]] = field(default_factory=list)  # (name, target type, delta type)

    @property
    def any(self) -> bool:
        return bool(self.added or self.removed or self.changed)


def diff(target: T.StructType, delta: T.StructType) -> SchemaDiff:
    t = {f.name.lower(): f for f in target.fields}
    d = {f.name.lower(): f for f in delta.fields}
    out = SchemaDiff()
    out.added = [f.name for f in delta.fields if f.name.lower() not in t]
    out.removed = [f.name for f in target.fields if f.name.lower() not in d]
    for k, f in t.items():
        if k in d and not widens(d[k].dataType, f.dataType):
            out.changed.append((f.name, f.dataType.simpleString(), d[k].dataType.simpleString()))
    return out


def reconcile(target: DataFrame, delta: DataFrame, mode: str = "ignore", log=print) -> tuple[DataFrame, DataFrame]:
    """Return ``(target', delta')`` with one common column list per ``mode``.

    * ``ignore``: target keeps its columns; the delta is projected onto them
      (new columns dropped, missing ones NULL).
    * ``append_new_columns``: target gains the new columns (NULL in old rows);
      removed columns stay (NULL in new rows); types are untouched.
    * ``sync_all_columns``: target becomes the delta's column set: removed
      columns dropped, new ones added, changed types recast to the delta's type.
    * ``fail``: any difference raises.
    An unknown mode falls back to ``ignore`` with a log line.
    """
    if mode not in MODES:
        log(f"on_schema_change={mode!r} is not one of {MODES}; using 'ignore'")
        mode = "ignore"
    if [(f.name, f.dataType) for f in target.schema.fields] == [(f.name, f.dataType) for f in delta.schema.fields]:
        return target, delta  # identical layout: nothing to reconcile
    dd = diff(target.schema, delta.schema)
    if mode == "fail" and dd.any:
        raise ValueError(f"schema change with on_schema_change='fail': added={dd.added} removed={dd.removed} "
                         f"changed={dd.changed}")
    ttypes = {f.name.lower(): f.dataType for f in target.schema.fields}
    dtypes = {f.name.lower(): f.dataType for f in delta.schema.fields}

    def project(df: DataFrame, names: list[str], types: dict) -> DataFrame:
        have = {c.lower(): c for c in df.columns}
        return df.select(*[(df[have[n.lower()]].cast(types[n.lower()]) if n.lower() in have
                            else F.lit(None).cast(types[n.lower()])).alias(n) for n in names])

    if mode in ("ignore", "fail"):
        names = target.columns
        return target, project(delta, names, ttypes)
    if mode == "append_new_columns":
        names = target.columns + dd.added
        types = {**dtypes, **ttypes}
        return project(target, names, types), project(delta, names, types)
    names = delta.columns
    return project(target, names, dtypes), project(delta, names, dtypes)
