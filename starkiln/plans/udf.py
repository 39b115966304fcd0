"""SQL scalar functions and Python models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import incremental as INC
from ..operators import sinks


def create_scalar(spark: SparkSession, name: str, args: Sequence[tuple[str, str]], returns: str, body: str) -> str:
    """Create or replace a SQL scalar function (inlined by Catalyst; no Python at run time)."""
    sig = ", ".join(f"{a} {t}" for a, t in args)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({sig}) RETURNS {returns} RETURN {body}")
    return name


@dataclass
class ModelContext:
    """What a Python model sees: refs to other relations, its own name, incremental state, config."""

    spark: SparkSession
    this: str
    refs: Mapping[str, DataFrame] = field(default_factory=dict)
    config: Mapping[str, object] = field(default_factory=dict)
    full_refresh: bool = False
    root: str | None = None  # where table versions are written (default: the warehouse dir)

    def ref(self, name: str) -> DataFrame:
        return self.refs[name] if name in self.refs else self.spark.table(name)

    def is_incremental(self) -> bool:
        return INC.is_incremental(self.spark, self.this, self.full_refresh)


def run_model(spark: SparkSession, fn: Callable[[ModelContext, SparkSession], object], ctx: ModelContext,
              materialize: bool = True) -> DataFrame:
    """Run a Python model; a pandas result is converted (Arrow) to a DataFrame; the result
    replaces table ``ctx.this`` when ``materialize``."""
    out = fn(ctx, spark)
    if not isinstance(out, DataFrame):
        out = spark.createDataFrame(out)
    if materialize:
        return sinks.as_table(out, ctx.this, root=ctx.root)
    return out
