"""Materializations: view, table, clustered table, clone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables as TB


def relation_kind(spark: SparkSession, name: str) -> str | None:
    return TB.kind(spark, name)


def as_view(df: DataFrame, name: str, full_refresh: bool = False) -> DataFrame:
    """Lazy view of ``df``.  A *table* holding the name is an error unless ``full_refresh``."""
    spark = df.sparkSession
    if TB.kind(spark, name) == "table":
        if not full_refresh:
            raise ValueError(f"{name} is a table; replacing it with a view needs full_refresh=True")
        TB.drop(spark, name)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def as_table(df: DataFrame, name: str, root: str | None = None, partition_by: Sequence[str] = (),
             cluster_by: Sequence[str] = (), full_refresh: bool = True) -> DataFrame:
    """Create or replace table ``name`` from ``df`` (a view in the way is dropped)."""
    spark = df.sparkSession
    if TB.kind(spark, name) == "view":
        TB.drop(spark, name)
    TB.write_version(df, name, root, partition_by, cluster_by)
    return spark.table(name)


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``keys`` (the layout a clustered write stores).

    A deterministic row hash is the last range key, so one hot key value can
    still be split across several range partitions (and a recomputed task
    after executor loss places every row exactly where it did before).
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).alias("__tie")
    ranged = df.withColumn("__tie", tie)
    ranged = (ranged.repartitionByRange(partitions, *keys, "__tie") if partitions
              else ranged.repartitionByRange(*keys, "__tie"))
    return ranged.sortWithinPartitions(*keys).drop("__tie")


def clone(spark: SparkSession, src: str, dst: str, as_view_fallback: bool = False, full_refresh: bool = False,
          root: str | None = None, shallow: bool = False) -> DataFrame:
    """Copy table ``src`` to ``dst``; no-op if ``dst`` exists (unless ``full_refresh``).

    ``as_view_fallback=True`` makes ``dst`` a view over ``src`` instead of a copy.
    ``shallow=True`` writes no data: ``dst`` is a table over the files that ``src`` has now.
    Later writes to one are unseen by the other: a new version goes to a folder of its own, and
    the side that is first appended to, or has partitions replaced, copies its files before.
    """
    if TB.kind(spark, dst) is not None and not full_refresh:
        return spark.table(dst)
    if as_view_fallback:
        return as_view(spark.table(src), dst, full_refresh=True)
    if shallow:
        if TB.kind(spark, src) != "table":
            raise ValueError(f"{src} is no table: nothing to share")
        TB.drop(spark, dst)
        TB.share(spark, src, dst, root)
        return spark.table(dst)
    parts = TB.partition_columns(spark, src)
    return as_table(spark.table(src), dst, root=root, partition_by=parts)
