"""Aggregates kept up to date from mergeable partials, one set per part of the source.

A part is what arrives, changes and goes as a whole: a source file.  The state of an aggregate
is the partial aggregate of every part (counts, sums, minima, maxima per group) with the
version of the part it was computed from.  A refresh computes the partials of new and changed
parts only, and merges: partials of a version that is no longer current don't count, so a
changed part needs no retraction, a removed one no deletion, and a minimum whose row left is
right without a look at any other part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables as TB

KINDS = ("count", "sum", "avg", "min", "max")
VERSION = "_part_version"


@dataclass(frozen=True)
class Measure:
    """Column ``name``: ``kind`` of ``column`` (a count without one counts rows), rounded if
    ``digits`` is given."""

    name: str
    kind: str
    column: str | None = None
    digits: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown measure {self.kind!r}; mergeable ones are {KINDS}")
        if self.column is None and self.kind != "count":
            raise ValueError(f"{self.kind} needs a column")

    def partial(self) -> list[Column]:
        c = F.lit(1) if self.column is None else F.col(self.column)
        made = {"n": F.count(c), "s": F.sum(c), "lo": F.min(c), "hi": F.max(c)}
        return [made[p].alias(f"{self.name}__{p}") for p in self._needs()]

    def _needs(self) -> tuple[str, ...]:
        return {"count": ("n",), "sum": ("s",), "avg": ("s", "n"), "min": ("lo",), "max": ("hi",)}[self.kind]

    def merge(self) -> Column:
        of = lambda p: F.col(f"{self.name}__{p}")
        out = {"count": lambda: F.coalesce(F.sum(of("n")), F.lit(0)).cast("long"), "sum": lambda: F.sum(of("s")),
               "avg": lambda: F.try_divide(F.sum(of("s")), F.sum(of("n"))), "min": lambda: F.min(of("lo")), "max": lambda: F.max(of("hi"))}[self.kind]()
        return (out if self.digits is None else F.round(out, self.digits)).alias(self.name)


def partials(rows: DataFrame, part: str, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return rows.groupBy(part, *keys).agg(*[c for m in measures for c in m.partial()])


def maintain_aggregate(spark: SparkSession, name: str, source: DataFrame, part: str, keys: Sequence[str],
                       measures: Sequence[Measure], versions: DataFrame, root: str | None = None) -> dict:
    """Create table ``name`` or bring it up to date with ``source``; the result equals a full
    recompute over the parts that ``versions`` lists.

    ``versions``: one row (``part``, ``version``) per part of the source now, e.g. from a
    listing's length and modification time; rows of other parts are left out.  Only parts
    whose version isn't the recorded one are read; their names enter the plan as literals, so a
    source partitioned by ``part`` is pruned to them.  State, result and record of versions
    are written in this order: a run that failed on the way is done again.
    Returns ``{"mode": "initial" | "incremental" | "noop", "parts_read": n}``.
    """
    state, record = f"{name}__partials", f"{name}__parts"
    now = versions.select(F.col(part).cast("string").alias(part), F.col("version").cast("string").alias(VERSION))
    first = TB.kind(spark, record) != "table"
    if first:
        todo, rows = now, source
    else:
        done = spark.table(record)
        todo = now.join(done, [part, VERSION], "left_anti")
        changed = [r[part] for r in todo.collect()]  # the parts this run reads
        if not changed and done.join(now, [part, VERSION], "left_anti").isEmpty():
            return {"mode": "noop", "parts_read": 0}
        rows = source.filter(F.col(part).isin(changed)) if changed else None
    if rows is not None:
        fresh = partials(rows, part, keys, measures).join(todo, part)
        if TB.kind(spark, state) != "table":
            TB.write_version(fresh, state, root, partition_by=[part])
        else:
            TB.overwrite_partitions(fresh, state, [part])
    held = spark.table(state).join(now, [part, VERSION], "left_semi")
    TB.write_version(held.groupBy(*keys).agg(*[m.merge() for m in measures]), name, root)
    TB.write_version(now, record, root)
    return {"mode": "initial" if first else "incremental", "parts_read": spark.table(record).count() if first else len(changed)}
