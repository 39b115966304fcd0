"""Trip-file ingest into the raw table (explicit projection + lineage).

The raw table is a Parquet table partitioned by ``_source_file`` (what a row belongs to) and
``_source_path`` (the physical file it came from, relative to the landing folder).  Two part
files of one source file, or two files of one base name in different folders, are different
paths: each is loaded once, and a repeated load replaces only what the same file wrote.
"""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Iterable, Sequence
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import micros_to_ntz
from ..schemas import RAW_TRIPS
from . import ledger as LG

# Spellings of the airport fee column seen across file vintages.
AIRPORT_FEE_SPELLINGS = ["Airport_fee", "airport_fee"]

#: Rows of a landing file that are written together; the column that numbers such pieces while a table is written.
CHUNK_ROWS, CHUNK = 250_000, "__chunk"


def coalesce_spellings(df: DataFrame, spellings: Sequence[str], out: str) -> DataFrame:
    """Fold columns that differ only in spelling/casing into ``out`` (first non-NULL wins).

    Under Spark's default case-insensitive resolution a single file with either
    spelling already resolves, but a frame carrying several spellings side by
    side is ambiguous by name, so the columns are renamed by position first.
    """
    names = df.columns
    hits = sorted((spellings.index(c), i) for i, c in enumerate(names) if c in spellings)
    if not hits:
        return df.withColumn(out, F.lit(None).cast("double"))
    tmp = [f"__spelling{i}" if c in spellings else c for i, c in enumerate(names)]
    d = df.toDF(*tmp)
    cols = [d[f"__spelling{i}"] for _, i in hits]
    folded = F.coalesce(*cols) if len(cols) > 1 else cols[0]
    return d.select(*[d[c] for c in tmp if not c.startswith("__spelling")], folded.alias(out))


def landing_path(landing_root: str) -> Column:
    """Path of the scanned file below ``landing_root`` (the whole path if it lies elsewhere), as
    the file system names it."""
    return LG.below(LG.decoded(F.col("_metadata.file_path")), landing_root)


def with_lineage(df: DataFrame, source_file: Column | str | None = None,
                 loaded_at: Column | str | None = None, landing_root: str | None = None) -> DataFrame:
    """Add ``_source_file`` (default: the scanned file's path below ``landing_root``, or its whole
    path) and ``_loaded_at`` (default: now)."""
    default = landing_path(landing_root) if landing_root else F.col("_metadata.file_path")
    sf = default if source_file is None else (
        F.col(source_file) if isinstance(source_file, str) else source_file)
    la = F.current_timestamp() if loaded_at is None else (
        F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at)
    return df.withColumn("_source_file", sf.cast("string")).withColumn("_loaded_at", la.cast("timestamp"))


def _as_raw_type(c: Column, name: str, field: T.StructField, src_type: T.DataType | None) -> Column:
    """Cast one landing column to its raw type; integer epochs become NTZ timestamps."""
    if isinstance(field.dataType, T.TimestampNTZType) and isinstance(src_type, (T.LongType, T.IntegerType)):
        return micros_to_ntz(c).alias(name)
    return c.cast(field.dataType).alias(name)


def ingest_trips(landing: DataFrame, raw_schema: T.StructType = RAW_TRIPS,
                 source_file: Column | str | None = None, loaded_at: Column | str | None = None,
                 source_path: Column | str | None = None, row_index: Column | None = None) -> DataFrame:
    """Project a landing frame onto the fixed raw schema, explicitly and by name.

    * columns are mapped by an explicit list, not by position;
    * airport-fee spellings are folded (first non-NULL);
    * epoch-microsecond integers become naive timestamps;
    * casts are strict (ANSI): any malformed value aborts the load;
    * lineage columns are added; with ``row_index`` (a row's place in its file) also the piece of
      the file that it lies in, as ``CHUNK``, for a writer that drops it.
    """
    df = coalesce_spellings(landing, AIRPORT_FEE_SPELLINGS, "__airport_fee")
    src_types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in raw_schema.fields:
        if field.name in ("_source_file", "_loaded_at"):
            continue
        src = "__airport_fee" if field.name in AIRPORT_FEE_SPELLINGS else field.name
        if src not in src_types:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            cols.append(_as_raw_type(df[src], field.name, field, src_types[src]))
    def pick(given, name, default):
        if given is not None:
            return F.col(given) if isinstance(given, str) else given
        return df[name] if name in src_types else default

    sf = pick(source_file, "_source_file", F.col("_metadata.file_path"))
    la = pick(loaded_at, "_loaded_at", F.current_timestamp())
    lineage = [sf.cast("string").alias("_source_file"), la.cast("timestamp").alias("_loaded_at")]
    if source_path is not None:
        lineage.append(pick(source_path, "_source_path", None).cast("string").alias("_source_path"))
    if row_index is not None:
        lineage.append(F.floor(row_index / CHUNK_ROWS).alias(CHUNK))
    return df.select(*cols, *lineage)


def read_landing(spark: SparkSession, paths: str | Sequence[str], landing_root: str | None = None) -> DataFrame:
    """Scan landing Parquet files with their own (file) schema plus the path they came from."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return with_lineage(spark.read.parquet(*paths), landing_root=landing_root or _root_of(paths)).drop("_loaded_at")


def _root_of(paths: Sequence[str]) -> str:
    """The landing folder: the path itself if there is one (and it is not a file), else the
    deepest folder above all of them."""
    if len(paths) == 1:
        return posixpath.dirname(paths[0]) if paths[0].endswith(".parquet") else paths[0]
    return posixpath.commonpath([urlparse(x).path for x in paths])


def rows_loaded(raw: DataFrame, fname: str) -> DataFrame:
    """Post-load row count for one file (suffix match on the lineage column)."""
    return raw.filter(F.col("_source_file").endswith(fname)).agg(F.count(F.lit(1)).alias("rows_loaded"))


def new_files(raw: DataFrame, candidates: DataFrame, force: bool = False) -> DataFrame:
    """Files in ``candidates`` (column ``_source_file``) not yet present in ``raw``.

    ``force=True`` returns every candidate (reload).  The distinct file list of
    ``raw`` comes from a partition-pruned scan of the partition column.
    """
    cand = candidates.select("_source_file").distinct()
    if force:
        return cand
    have = raw.select("_source_file").distinct()
    return cand.join(have, "_source_file", "left_anti")


def load_if_absent(raw: DataFrame, landing: DataFrame, force: bool = False) -> DataFrame:
    """Rows of ``landing`` whose ``_source_file`` is not in ``raw`` yet (all rows when forced)."""
    if force:
        return landing
    return landing.join(raw.select("_source_file").distinct(), "_source_file", "left_anti")


def target_months(override: str | None = None, today: dt.date | None = None, lag: int = 2,
                  count: int = 1) -> list[str]:
    """Months to load: the override (``YYYY-MM`` or ``YYYY-MM,YYYY-MM``) or today minus ``lag`` months."""
    if override and override.strip():
        parts = [p.strip() for p in override.split(",")]
        lo = dt.date.fromisoformat(parts[0] + "-01")
        hi = dt.date.fromisoformat(parts[-1] + "-01")
        out, cur = [], lo
        while cur <= hi:
            out.append(f"{cur.year}-{cur.month:02d}")
            cur = dt.date(cur.year + (cur.month == 12), cur.month % 12 + 1, 1)
        return out
    today = today or dt.date.today()
    idx = today.year * 12 + today.month - 1 - lag
    months = []
    for k in range(count):
        y, m = divmod(idx - k, 12)
        months.append(f"{y}-{m + 1:02d}")
    return sorted(months)


def month_files(months: Iterable[str], pattern: str = "trips_{month}.parquet") -> list[str]:
    return [pattern.format(month=m) for m in months]


def load_months(spark: SparkSession, landing_dir: str, months: Iterable[str],
                pattern: str = "trips_{month}.parquet", loaded_at: Column | None = None) -> DataFrame:
    """Backfill: the chosen month files, whatever their vintages, projected into the raw schema."""
    paths = [f"{landing_dir.rstrip('/')}/{f}" for f in month_files(months, pattern)]

    def project(land: DataFrame) -> DataFrame:
        if "_source_file" in land.columns:
            return ingest_trips(land, loaded_at=loaded_at)
        return ingest_trips(land, source_file=landing_path(landing_dir), loaded_at=loaded_at)

    return union_of([project(spark.read.schema(schema).parquet(*some)) for schema, some in vintages(spark, paths)])


def union_of(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def vintages(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by schema: ``(schema, paths)`` with one physical type per column.

    Spark merges the footers of a group in parallel, column spellings that differ in case
    included; where two files disagree on a type the group is halved.  Files of a vintage stand
    together when sorted by name, so this takes a few merges per vintage, not one per file.
    Columns that only some files of a group have are NULL in the others.
    """
    reader = spark.read.option("mergeSchema", "true")
    if base is not None:
        reader = reader.option("basePath", base)

    def split(some: list[str]) -> list[tuple[T.StructType, list[str]]]:
        try:
            return [(reader.parquet(*some).schema, some)]
        except (PySparkException, Py4JJavaError) as e:  # the merge runs in a job: its error, as it is
            if len(some) == 1 or "CANNOT_MERGE" not in str(e):  # what is not a clash of types is an error
                raise
        half = len(some) // 2
        return split(some[:half]) + split(some[half:])

    out: list[tuple[dict, T.StructType, list[str]]] = []
    for schema, some in split(sorted(paths)):
        types = {f.name.lower(): f.dataType for f in schema.fields}
        for i, (held, first, files) in enumerate(out):
            if held == types:  # halves of one vintage come together again
                out[i] = (held, first, files + some)
                break
        else:
            out.append((types, schema, some))
    return [(schema, some) for _, schema, some in out]


def load_files(spark: SparkSession, paths: str | Sequence[str], table: str, root: str | None = None,
               force: bool = False, replace: bool = False, source_file_col: str | None = None,
               schema: T.StructType | None = None, landing_root: str | None = None) -> DataFrame:
    """The load job: landing files -> raw table (partitioned by ``_source_file, _source_path``).

    * files to read are resolved first: those whose path below the landing folder, length and
      modification time the table's ledger (:mod:`.ledger`) doesn't hold.  So a file replaced
      under its name is read again and its rows take the place of the earlier ones; ``force``
      reads all files;
    * files of several vintages may come together: each group of files with the same column
      types is read with its own schema and cast to the raw one (:func:`vintages`);
    * ``_source_file`` is ``source_file_col`` (e.g. a partition column of the landing layout)
      or else the path itself;
    * ``replace=False`` with ``force`` adds a later batch (resolved downstream by the
      latest-batch rule); otherwise each file's own partition is written, so repeating a load
      after a failure changes nothing and no file touches what another one wrote.  The ledger
      is written last: a load that failed before is done again;
    * any malformed value aborts the whole load (strict casts);
    * returns the rows loaded per source file by this call, counted from the written table.
    """
    from ..operators import tables as TB

    paths = [paths] if isinstance(paths, str) else list(paths)
    landing_root = landing_root or _root_of(paths)
    exists = TB.kind(spark, table) == "table"
    files = LG.listing(spark, paths, landing_root)
    if exists and not force:
        if not spark.catalog.tableExists(LG.name_of(table)):  # a table of an earlier layout: take its files as they are
            LG.record(files.join(spark.table(table).select("_source_path").distinct(), "_source_path", "left_semi"), table, root)
        files = LG.to_read(files, table)
    chosen = files.collect()  # what this call reads
    names = spark.createDataFrame([(r["_source_path"],) for r in chosen], "_source_path string")
    if chosen:
        new = [LG.as_path(r["path"]) for r in chosen]
        groups = [(schema, new)] if schema is not None else vintages(spark, new, landing_root)
        path = landing_path(landing_root)  # partition columns of the landing layout come from the folders above a file
        raw = union_of([ingest_trips(spark.read.schema(kind).option("basePath", landing_root).parquet(*some),
                                     source_file=F.col(source_file_col) if source_file_col else path, source_path=path,
                                     row_index=F.col("_metadata.row_index")) for kind, some in groups])
        parts = ["_source_file", "_source_path"]
        if not exists:
            TB.write_version(raw, table, root, partition_by=parts, chunk=CHUNK)
        elif force and not replace:
            TB.append(raw, table)
        else:
            TB.overwrite_partitions(raw, table, parts, chunk=CHUNK)
        LG.record(spark.createDataFrame(chosen, files.schema), table, root)
    elif not exists:
        raise ValueError(f"no landing files below {paths}")
    per_file = spark.table(table).groupBy("_source_file", "_source_path").agg(F.count(F.lit(1)).alias("n"))
    return per_file.join(F.broadcast(names), "_source_path", "left_semi").groupBy("_source_file").agg(
        F.sum("n").alias("rows_loaded"))
