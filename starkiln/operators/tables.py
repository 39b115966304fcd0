"""Catalog tables over versioned Parquet directories.

Plain Parquet tables take no DELETE, MERGE, DROP COLUMN or type change, so a
table rewrite writes a *new version directory* and then repoints the catalog
table at it (``ALTER TABLE ... SET LOCATION``, or a new definition of the external table if
it is partitioned or its schema changes); readers see the old version or the new one, never a
half-written directory, and the path being read is never overwritten.  When only some partitions change, Spark's dynamic partition
overwrite rewrites just those partitions in place instead.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Prefix of the library's own table properties.
PREFIX = "starkiln."


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def kind(spark: SparkSession, name: str) -> str | None:
    """'table', 'view' or None."""
    if not spark.catalog.tableExists(name):
        return None
    t = spark.catalog.getTable(name).tableType
    return "view" if t in ("VIEW", "TEMPORARY") else "table"


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns, from one ``DESCRIBE TABLE`` (a single round trip)."""
    rows = spark.sql(f"DESCRIBE TABLE {name}").collect()
    out, in_parts = [], False
    for r in rows:
        col = (r["col_name"] or "").strip()
        if col == "# Partition Information":
            in_parts = True
        elif in_parts and col and not col.startswith("#"):
            out.append(col)
    return out


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The library's own properties of a table, without their prefix."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"].removeprefix(PREFIX): r["value"] for r in rows if r["key"].startswith(PREFIX)}


def set_properties(spark: SparkSession, name: str, **values) -> None:
    given = ", ".join(f"'{PREFIX}{k}' = '{v}'" for k, v in values.items() if v is not None)
    if given:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({given})")


def share(spark: SparkSession, src: str, dst: str, root: str | None = None) -> None:
    """Define ``dst`` over the files of ``src``; both are marked as sharing them.

    A new version of either side is written elsewhere anyway; the writes that change a folder
    in place (append, overwritten or cleared partitions) call :func:`detach` first.
    """
    parts = partition_columns(spark, src)
    cols = spark.table(src)
    cols = cols.select(*[c for c in cols.columns if c not in parts], *parts)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {dst} ({_ddl(cols)}) USING parquet{part} LOCATION '{location(spark, src)}'")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {dst} SYNC PARTITIONS")
    own = {k: v for k, v in properties(spark, src).items() if k not in ("shared_files", "versions_at")}
    set_properties(spark, dst, **own, shared_files="true", versions_at=base_path(spark, dst, root))
    set_properties(spark, src, shared_files="true")


def detach(spark: SparkSession, name: str, df: DataFrame | None = None) -> None:
    """Give a table that shares its files a copy of its own, before they change in place (unless
    the rows to write, ``df``, are none)."""
    p = properties(spark, name)
    if p.get("shared_files") != "true" or (df is not None and df.isEmpty()):
        return
    write_version(spark.table(name), name, None, partition_columns(spark, name))
    set_properties(spark, name, **{k: v for k, v in p.items() if k not in ("shared_files", "versions_at")})


def base_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """Where versions of ``name`` live: ``root/name`` or the warehouse dir."""
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def _new_version_dir(base: str) -> str:
    return f"{base}/_v{int(time.time() * 1000):013d}_{uuid.uuid4().hex[:8]}"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def counted(df: DataFrame, seen: Observation | None) -> DataFrame:
    """``df``, its rows counted by ``seen`` as they are written.  This stands right above the write,
    behind every shuffle, so a stage that runs again does not count twice."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("n"))


def gathered(df: DataFrame, parts: Sequence[str], chunk: str | None = None) -> DataFrame:
    """Rows of a partition in few tasks; AQE splits a hot partition value across tasks, but not below
    what one task before it read.  A write task sorts what it gets, so where one task may read a
    large partition, the column ``chunk`` cuts it in pieces (and is dropped)."""
    if not parts:
        return df.drop(chunk) if chunk else df
    return df.hint("rebalance", *parts, chunk).drop(chunk) if chunk else df.hint("rebalance", *parts)


def write_version(df: DataFrame, name: str, root: str | None = None, partition_by: Sequence[str] = (),
                  cluster_by: Sequence[str] = (), seen: Observation | None = None, chunk: str | None = None) -> str:
    """Write ``df`` as a new version of table ``name`` and switch the table to it.

    ``cluster_by`` range-partitions and sorts rows by those keys before writing
    so Parquet row-group min/max statistics prune well on later filters.
    """
    spark = df.sparkSession
    existing = kind(spark, name) == "table"
    base = base_path(spark, name, root)
    props = properties(spark, name) if existing else {}
    if "versions_at" in props:  # a clone: the files so far lie in the folder of its source
        base = props["versions_at"]
    elif existing:
        loc = location(spark, name)
        base = loc.rsplit("/_v", 1)[0] if "/_v" in loc else base
    path = _new_version_dir(base)
    out = df
    if cluster_by:
        from .sinks import clustered

        out = clustered(out, cluster_by)
    elif partition_by:
        out = gathered(out, partition_by, chunk)
    w = counted(out, seen).write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    cols = df.select(*[c for c in df.columns if c not in partition_by and c != chunk], *partition_by)
    same_layout = existing and [(f.name, f.dataType) for f in spark.table(name).schema.fields] == \
        [(f.name, f.dataType) for f in cols.schema.fields] and partition_columns(spark, name) == list(partition_by)
    if same_layout and not partition_by:
        # readers see the old version or the new one, never a partial directory
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        if "shared_files" in props:
            spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{PREFIX}shared_files', '{PREFIX}versions_at')")
    else:
        if existing:
            # a new schema needs a new table definition, and so do partitions: each has its own
            # location in the catalog, which SET LOCATION leaves as it is (external: no data is deleted)
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({_ddl(cols)}) USING parquet{part} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return path


def overwrite_partitions(df: DataFrame, name: str, parts: Sequence[str] | None = None, seen: Observation | None = None,
                         chunk: str | None = None) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition overwrite)."""
    spark = df.sparkSession
    detach(spark, name, df)
    cols = spark.table(name).columns
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    parts = partition_columns(spark, name) if parts is None else list(parts)
    out = gathered(df.select(*cols, *([chunk] if chunk else [])), parts, chunk)
    counted(out, seen).write.mode("overwrite").insertInto(name)
    spark.sql(f"REFRESH TABLE {name}")


def append(df: DataFrame, name: str, seen: Observation | None = None) -> None:
    detach(df.sparkSession, name, df)
    cols = df.sparkSession.table(name).columns
    counted(df.select(*cols), seen).write.mode("append").insertInto(name)
    df.sparkSession.sql(f"REFRESH TABLE {name}")


def drop(spark: SparkSession, name: str) -> None:
    k = kind(spark, name)
    if k == "view":
        spark.catalog.dropTempView(name) or spark.sql(f"DROP VIEW IF EXISTS {name}")
    elif k == "table":
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _sql_literal(v) -> str:
    import datetime as dt

    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP'{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def clear_partitions(spark: SparkSession, name: str, specs: Sequence[dict]) -> None:
    """Empty the given partitions (static ``INSERT OVERWRITE ... PARTITION`` of zero rows).

    Dynamic partition overwrite only replaces partitions that receive rows; a
    partition whose rows were all deleted has to be cleared explicitly.
    """
    if not specs:
        return
    detach(spark, name)
    parts = list(specs[0])
    data_cols = [f for f in spark.table(name).schema.fields if f.name not in parts]
    view = f"__empty_{abs(hash(name))}"
    from pyspark.sql import types as T

    spark.createDataFrame([], T.StructType(data_cols)).createOrReplaceTempView(view)
    cols = ", ".join(f"`{f.name}`" for f in data_cols)
    for spec in specs:
        if any(v is None for v in spec.values()):
            raise ValueError("cannot clear a NULL partition by spec")
        ps = ", ".join(f"`{k}` = {_sql_literal(v)}" for k, v in spec.items())
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({ps}) SELECT {cols} FROM {view}")
    spark.catalog.dropTempView(view)
    spark.sql(f"REFRESH TABLE {name}")
