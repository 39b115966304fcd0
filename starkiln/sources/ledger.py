"""Which physical files a raw table was loaded from: path, length and modification time.

A file is known by its path below the landing folder and unchanged while its length and
modification time are the recorded ones, so a file that is replaced under its name is read
again.  Listings and the ledger are relations; only the paths of files that have to be read
reach the driver, because a reader takes its paths there.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "_source_path string, length long, modified timestamp, recorded_at timestamp"


def decoded(path: Column) -> Column:
    """A file path as the file system names it, from its URL-encoded form in ``_metadata``."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def below(path: Column, landing_root: str) -> Column:
    """``path`` (decoded) below ``landing_root``; the whole path if it lies elsewhere."""
    root = urlparse(landing_root).path.rstrip("/") + "/"
    at = F.instr(path, root)
    return F.when(at > 0, F.substr(path, at + F.lit(len(root)))).otherwise(path)


def as_path(name: str) -> str:
    """A file name as a reader's path: characters of path patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def listing(spark: SparkSession, paths: Sequence[str], landing_root: str) -> DataFrame:
    """Files below ``paths``: _source_path, path, length, modified.  No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select(below(F.col("path"), landing_root).alias("_source_path"), "path", "length",
                        F.col("modificationTime").alias("modified"))


def name_of(table: str) -> str:
    return f"{table}__files"


def recorded(spark: SparkSession, table: str) -> DataFrame:
    """The last recorded state of every file of ``table``."""
    name = name_of(table)
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], SCHEMA)
    last = F.max_by(F.struct("length", "modified"), F.col("recorded_at")).alias("last")
    return spark.table(name).groupBy("_source_path").agg(last).select("_source_path", "last.length", "last.modified")


def record(files: DataFrame, table: str, root: str | None = None) -> None:
    """Add the state of ``files`` (_source_path, length, modified) to the ledger."""
    from ..operators import tables as TB

    spark, name = files.sparkSession, name_of(table)
    rows = files.select("_source_path", "length", "modified", F.current_timestamp().alias("recorded_at"))
    if TB.kind(spark, name) == "table":
        TB.append(rows, name)
    else:
        TB.write_version(rows, name, root)


def to_read(files: DataFrame, table: str) -> DataFrame:
    """Files of a listing that ``table`` doesn't hold in their present state: new or changed."""
    return files.join(recorded(files.sparkSession, table), ["_source_path", "length", "modified"], "left_anti")


def changed(files: DataFrame, table: str) -> DataFrame:
    """Files of a listing that ``table`` holds in an earlier state."""
    known = recorded(files.sparkSession, table).select("_source_path")
    return to_read(files, table).join(known, "_source_path", "left_semi")
