"""CSV sources: the zone lookup and generic seeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_ZONES


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header, read against a declared schema (malformed rows fail)."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(RAW_ZONES).csv(path))


def seed(spark: SparkSession, csv_path: str, column_types: Mapping[str, str] | None = None,
         table: str | None = None, full_refresh: bool = False) -> DataFrame:
    """Load a CSV seed: inferred types with per-column overrides.

    Overridden columns are read as text first and then cast, so an override to
    ``string`` keeps leading zeros that inference would have dropped.  When a
    ``table`` is given the seed replaces it (an existing *view* of that name is an
    error unless ``full_refresh``).
    """
    column_types = dict(column_types or {})
    text = spark.read.option("header", True).option("inferSchema", False).csv(csv_path)
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(csv_path)
    cols = []
    for name in text.columns:
        if name in column_types:
            cols.append(text[name].cast(column_types[name]).alias(name))
        else:
            cols.append(text[name].cast(inferred.schema[name].dataType).alias(name))
    df = text.select(*cols)
    if table:
        from ..operators.sinks import as_table, relation_kind

        if relation_kind(spark, table) == "view" and not full_refresh:
            raise ValueError(f"{table} is a view; seeds load into tables (use full_refresh=True)")
        as_table(df, table, full_refresh=True)
        return spark.table(table)
    return df


def zones_from_rows(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, RAW_ZONES).select(*[F.col(c) for c in RAW_ZONES.names])
