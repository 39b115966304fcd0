"""Incremental write strategies.

``apply_*`` functions are pure: ``(target, delta, ...) -> new target state`` as
a lazy DataFrame.  :func:`incremental` is the materialization: it freezes the
delta, reconciles schemas, and stores the new state the cheapest correct way:

* key == partition columns (the pipeline's delete+insert on ``_source_file``):
  dynamic partition overwrite -- the target is never read, only the touched
  partitions are rewritten;
* a table stored in buckets of its key (``key_buckets``): merge and delete+insert on that key
  read and rewrite the buckets of the delta's keys only;
* other keys: ``target anti-join distinct delta keys  UNION ALL  delta``
  written as a new table version (a plain anti join).
"""

from __future__ import annotations

import datetime as dt
import threading
from bisect import bisect_right
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schema_change as SC
from . import tables as TB
from .filters import literal_of

#: Partition column of a table stored in buckets of its key.
KEY_BUCKET = "_key_bucket"

STRATEGIES = ("append", "delete+insert", "merge", "insert_overwrite", "microbatch")


def _keys(k) -> list[str]:
    if k is None:
        return []
    return [k] if isinstance(k, str) else list(k)


def _pred(predicates) -> Column | None:
    if not predicates:
        return None
    ps = [predicates] if isinstance(predicates, (str, Column)) else list(predicates)
    out = None
    for p in ps:
        c = F.expr(p) if isinstance(p, str) else p
        out = c if out is None else out & c
    return out


def default_strategy(warehouse_default: bool = True) -> str:
    """Default when none is configured: merge (warehouse adapter) or append (generic)."""
    return "merge" if warehouse_default else "append"


def apply_append(target: DataFrame, delta: DataFrame) -> DataFrame:
    return target.unionByName(delta.select(*target.columns))


def apply_delete_insert(target: DataFrame, delta: DataFrame, unique_key, predicates=None) -> DataFrame:
    """Delete target rows whose key tuple is among the delta's distinct keys (and match every
    predicate), then insert *all* delta rows, duplicates included.  No key -> insert only.
    Keys compare with ``=``: a NULL key is never deleted."""
    keys = _keys(unique_key)
    d = delta.select(*target.columns)
    if not keys:
        return target.unionByName(d)
    kdf = delta.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    cond = None
    for i, k in enumerate(keys):
        c = target[k] == kdf[f"__k{i}"]
        cond = c if cond is None else cond & c
    p = _pred(predicates)
    if p is not None:
        cond = cond & p
    kept = target.join(kdf, cond, "left_anti")
    return kept.unionByName(d)


def merge_update_columns(columns: Sequence[str], update_columns=None, exclude_columns=None) -> list[str]:
    if update_columns and exclude_columns:
        raise ValueError("merge_update_columns and merge_exclude_columns cannot both be set")
    if update_columns:
        return list(update_columns)
    if exclude_columns:
        ex = {c.lower() for c in exclude_columns}
        return [c for c in columns if c.lower() not in ex]
    return list(columns)


def duplicate_keys(delta: DataFrame, unique_key) -> DataFrame:
    keys = _keys(unique_key)
    nn = None
    for k in keys:
        nn = F.col(k).isNotNull() if nn is None else nn & F.col(k).isNotNull()
    return delta.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def apply_merge(target: DataFrame, delta: DataFrame, unique_key, update_columns=None, exclude_columns=None,
                predicates=None, check_duplicates: bool = True) -> DataFrame:
    """Upsert: matched target rows take the delta's values for the update columns; unmatched
    delta rows are inserted; duplicate delta keys are an error.  No key -> insert only.

    Planned without a full outer join:

    * ``target LEFT JOIN delta`` applies the updates.  A small delta is broadcast by
      Spark, so the target is scanned but not shuffled; else it is a shuffle left join.
    * the delta keys that matched are found by a key-only semi join of the
      target (column-pruned scan), and the inserts are the delta rows outside them.

    Rows with a NULL key can never match, so they bypass both joins.
    """
    keys = _keys(unique_key)
    cols = target.columns
    d = delta.select(*cols)
    if not keys:
        return target.unionByName(d)
    if check_duplicates and duplicate_keys(d, keys).limit(1).count() > 0:
        raise ValueError(f"merge source has duplicate rows for unique_key {keys}")
    upd = {c.lower() for c in merge_update_columns(cols, update_columns, exclude_columns)}
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    t_keyed, t_null = target.filter(nn), target.filter(~nn)
    d_keyed, d_null = d.filter(nn), d.filter(~nn)
    p = _pred(predicates)  # written against target columns; false/NULL -> the row cannot match
    tp = F.coalesce(p, F.lit(False)) if p is not None else F.lit(True)

    s = d_keyed.select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__s"))
    t = t_keyed.withColumn("__tp", tp)
    cond = t["__tp"]
    for k in keys:
        cond = cond & (t[k] == s[f"__s_{k}"])
    j = t.join(s, cond, "left")
    hit = F.col("__s").isNotNull()
    updated = j.select(*[(F.when(hit, F.col(f"__s_{c}")).otherwise(F.col(c)) if c.lower() in upd else F.col(c))
                         .alias(c) for c in cols])

    sk = s.select(*[F.col(f"__s_{k}").alias(f"__m_{k}") for k in keys])
    mcond = None
    for k in keys:
        e = t[k] == sk[f"__m_{k}"]
        mcond = e if mcond is None else mcond & e
    matched = t.filter(t["__tp"]).select(*keys).join(sk, mcond, "left_semi").distinct()
    ins = d_keyed.join(matched, keys, "left_anti")
    return updated.unionByName(t_null).unionByName(ins).unionByName(d_null)


def apply_insert_overwrite(target: DataFrame, delta: DataFrame, predicates=None, columns=None,
                           whole_table: bool = True) -> DataFrame:
    """Insert-overwrite.

    * ``whole_table`` (warehouse variant): the table becomes the delta; with a
      column subset the other columns are NULL.
    * otherwise (generic variant): target rows matching ``predicates`` (all rows
      when none) are deleted, delta rows inserted; rows whose predicate is NULL stay.
    """
    cols = target.columns
    if columns:
        keep = {c.lower() for c in columns}
        d = delta.select(*[(F.col(c) if c.lower() in keep else F.lit(None).cast(target.schema[c].dataType)).alias(c)
                           for c in cols])
    else:
        d = delta.select(*cols)
    if whole_table and not predicates:
        return d
    p = _pred(predicates)
    kept = target.filter(~F.coalesce(p, F.lit(False))) if p is not None else target.filter(F.lit(False))
    return kept.unionByName(d)


def batch_windows(start, end, batch_size: str = "day") -> list[tuple[dt.datetime, dt.datetime]]:
    """Half-open ``[lo, hi)`` batch windows covering ``[start, end)``."""
    def to_dt(x):
        if isinstance(x, str):
            x = dt.datetime.fromisoformat(x)
        return x if isinstance(x, dt.datetime) else dt.datetime.combine(x, dt.time())
    lo, hi = to_dt(start), to_dt(end)
    step = {"hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}.get(batch_size)
    out = []
    cur = lo
    while cur < hi:
        if step is not None:
            nxt = cur + step
        elif batch_size == "month":
            nxt = dt.datetime(cur.year + (cur.month == 12), cur.month % 12 + 1, 1)
        elif batch_size == "year":
            nxt = dt.datetime(cur.year + 1, 1, 1)
        else:
            raise ValueError(f"unsupported batch_size {batch_size!r}")
        out.append((cur, min(nxt, hi)))
        cur = nxt
    return out


def event_range(df: DataFrame, event_time: str, start, end, batch_size: str) -> Column | None:
    """``start <= event_time < end`` in the column's own type, or None for an empty range."""
    wins = batch_windows(start, end, batch_size)
    if not wins:
        return None
    kind = df.schema[event_time].dataType
    lo, hi = (literal_of(x.isoformat(sep=" "), kind) for x in (wins[0][0], wins[-1][1]))
    return (F.col(event_time) >= lo) & (F.col(event_time) < hi)


def apply_microbatch(target: DataFrame, delta: DataFrame, event_time: str, start, end,
                     batch_size: str = "day") -> DataFrame:
    """For every batch window in ``[start, end)``: delete target rows whose ``event_time`` falls in it
    and insert the delta rows that do.  The windows tile ``[start, end)``, so the combined
    effect is one range replacement; it is planned as a single pass."""
    old = event_range(target, event_time, start, end, batch_size)
    if old is None:
        return target
    kept = target.filter(~F.coalesce(old, F.lit(False)))
    return kept.unionByName(delta.select(*target.columns).filter(event_range(delta, event_time, start, end, batch_size)))


# -- materialization -------------------------------------------------------------
def scope_to_partitions(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Target rows in the partitions listed by ``touched``: a NULL-safe semi join on the partition
    columns (``PARTITION BY`` groups NULLs).  A broadcast list prunes the scan to its partitions."""
    cond = None
    for p_ in parts:
        e = target[p_].eqNullSafe(touched[p_])
        cond = e if cond is None else cond & e
    return target.join(touched, cond, "left_semi")


def _range_scoped_rewrite(spark, name, target, delta, parts, strategy, predicates, opts, n):
    """Rewrite only the partitions that a microbatch range / overwrite predicate touches.

    Affected partitions = partitions of the target rows the strategy deletes plus
    partitions of the delta rows it inserts.  They are rewritten from a frozen result; those
    left without rows are cleared (only their names, which the catalog lists anyway, reach
    the driver).  Returns None (a full rewrite follows) when a NULL partition is left empty,
    which no partition spec can name.
    """
    if strategy == "microbatch":
        args = opts["event_time"], opts["begin"], opts["end"], opts.get("batch_size", "day")
        hit = event_range(target, *args)
        if hit is None:
            return {"mode": "noop", "rows_inserted": 0}
        ins = delta.filter(event_range(delta, *args))
    else:
        hit, ins = _pred(predicates), delta
    touched = target.filter(F.coalesce(hit, F.lit(False))).select(*parts).unionByName(ins.select(*parts)).distinct()
    touched = stable(touched)
    scope = scope_to_partitions(target, touched, parts)
    if strategy == "microbatch":
        new = apply_microbatch(scope, delta, *args)
    else:
        new = apply_insert_overwrite(scope, delta, predicates, opts.get("columns"), whole_table=False)
    frozen = stable(new)
    full = frozen.select(*parts).distinct()
    cond = F.lit(True)
    for p_ in parts:
        cond = cond & touched[p_].eqNullSafe(full[p_])
    emptied = [r.asDict() for r in touched.join(full, cond, "left_anti").collect()]
    if any(v is None for sp in emptied for v in sp.values()):
        return None
    if not frozen.isEmpty():
        TB.overwrite_partitions(frozen, name, parts)
    with _CLEARING:  # unlike the dynamic overwrite, this one has no staging folder of its own
        TB.clear_partitions(spark, name, emptied)
    return {"mode": "partition_rewrite", "rows_inserted": n}


class BatchError(RuntimeError):
    """Batch windows that failed, as ``failed``: (begin, end, error); all others are committed."""

    def __init__(self, failed):
        super().__init__(f"{len(failed)} batch windows failed, the first from {failed[0][0]} to {failed[0][1]}: {failed[0][2]}")
        self.failed = failed


def independent_windows(windows: Sequence[tuple], target: DataFrame, delta: DataFrame, event_time: str, parts: Sequence[str],
                        batch_size: str) -> list[tuple[list[tuple], set]]:
    """Groups of windows that share no partition, each with its partitions (values as text).

    One aggregate over event time and partition columns: the first and last event of each
    partition and calendar unit.  What reaches the driver is names of partitions.
    """
    rows = None
    for df in (target, delta):
        hit = df.filter((F.col(event_time) >= literal_of(windows[0][0].isoformat(sep=" "), df.schema[event_time].dataType))
                        & (F.col(event_time) < literal_of(windows[-1][1].isoformat(sep=" "), df.schema[event_time].dataType)))
        one = hit.select(F.col(event_time).cast("string").alias("__at"), *[F.col(p).cast("string").alias(p) for p in parts],
                         F.date_trunc(batch_size, F.col(event_time)).cast("string").alias("__unit"))
        one = one.groupBy("__unit", *parts).agg(F.min("__at").alias("lo"), F.max("__at").alias("hi"))
        rows = one if rows is None else rows.unionByName(one)
    begins = [lo for lo, _ in windows]
    group = list(range(len(windows)))

    def top(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    owner: dict = {}
    for r in rows.collect():
        part = tuple(r[p] for p in parts)
        lo, hi = (bisect_right(begins, dt.datetime.fromisoformat(x)) - 1 for x in (r["lo"], r["hi"]))
        for i in range(lo, hi + 1):
            group[top(i)] = top(owner.setdefault(part, i))
    out: dict = {}
    for i, w in enumerate(windows):
        out.setdefault(top(i), ([], set()))[0].append(w)
    for part, i in owner.items():
        out[top(i)][1].add(part)
    return list(out.values())


#: Clearing a partition uses the table folder's one temporary folder.
_CLEARING = threading.Lock()


def _rewrite_windows(spark, name, delta, parts, opts, n, root) -> int:
    """Every batch window as a commit of its own; returns their number.

    ``concurrent`` (1): how many groups of windows run at once, each in a scheduler pool of its
    own (the cluster's ``spark.scheduler.mode`` says whether pools share executors fairly).
    Windows that touch a common partition follow one another.  ``retries`` (0): further tries
    of a window.  A window that fails leaves the others committed; then BatchError names it.
    """
    event_time, size = opts["event_time"], opts.get("batch_size", "day")
    windows = batch_windows(opts["begin"], opts["end"], size)
    at_once = int(opts.get("concurrent", 1))
    if at_once > 1 and windows:
        TB.detach(spark, name, delta)
        groups = independent_windows(windows, spark.table(name), delta, event_time, parts, size)
    else:
        groups = [(windows, None)]
    failed, whole = [], []

    def run(i: int, group) -> None:
        wins, own = group
        if at_once > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"batch-{i % at_once}")
        for lo, hi in wins:
            for left in range(int(opts.get("retries", 0)), -1, -1):
                try:
                    now = spark.table(name)
                    if own is not None:  # the scan lists no file that another group replaces
                        mine = F.lit(False)
                        for values in sorted(own, key=str):
                            one = F.lit(True)
                            for p, v in zip(parts, values):
                                one = one & F.col(p).cast("string").eqNullSafe(F.lit(v))
                            mine = mine | one
                        now = now.filter(mine)
                    if _range_scoped_rewrite(spark, name, now, delta, parts, "microbatch", None, {**opts, "begin": lo, "end": hi}, n) is None:
                        whole.append((lo, hi))
                    break
                except Exception as e:  # noqa: BLE001 - named in the BatchError below
                    if not left:
                        failed.append((lo, hi, e))

    if at_once > 1:
        with ThreadPoolExecutor(at_once) as pool:
            for f in [pool.submit(inheritable_thread_target(spark)(run), i, g) for i, g in enumerate(groups)]:
                f.result()
    else:
        run(0, groups[0])
    for lo, hi in whole:  # a NULL partition is left empty: the table is written anew
        TB.write_version(apply_microbatch(spark.table(name), delta, event_time, lo, hi, size), name, root, parts)
    if failed:
        raise BatchError(sorted(failed, key=lambda x: x[0]))
    return len(windows)


def is_incremental(spark: SparkSession, name: str, full_refresh: bool = False) -> bool:
    """True iff the target exists, is a table, and no full refresh was asked for."""
    return (not full_refresh) and TB.kind(spark, name) == "table"


def stable(df: DataFrame) -> DataFrame:
    """Freeze a delta as a Parquet temp table in the cluster's shared checkpoint folder.

    Multi-step strategies must read one fixed delta even after the target it
    was computed from has been repointed.  Writing it once (one job, no
    recomputation, unlike an RDD checkpoint of an uncached plan) and reading it
    back also cuts the lineage, so a lost executor never forces the delta to be
    recomputed against a changed target.
    """
    import uuid

    from ..session import scratch_path

    path = scratch_path(df.sparkSession, "deltas", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key: by the text of its values, so it doesn't depend on the delta's types."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def key_layout(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """``(keys, buckets)`` of a table stored in buckets of its key, else None."""
    if TB.kind(spark, name) != "table" or KEY_BUCKET not in spark.table(name).columns:
        return None
    p = TB.properties(spark, name)
    return p["bucket_keys"].split(","), int(p["key_buckets"])


def touched_buckets(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Target rows in the buckets that the delta's keys fall in.  There are at most as many as
    the table has buckets; they enter the plan as literals, so the scan is pruned to them."""
    hit = sorted(r[0] for r in delta.select(KEY_BUCKET).distinct().collect())
    return target.filter(F.col(KEY_BUCKET).isin(hit))


def reads_table(spark: SparkSession, df: DataFrame, name: str) -> bool:
    """Whether the plan of ``df`` scans files of table ``name``."""
    at = TB.location(spark, name).split(":", 1)[-1].replace("//", "/").rstrip("/") + "/"
    return any(at in f.split(":", 1)[-1].replace("//", "/") for f in df.inputFiles())


def incremental(spark: SparkSession, name: str, model, strategy: str = "delete+insert", unique_key=None,
                on_schema_change: str = "ignore", predicates=None, full_refresh: bool = False,
                partition_by: Sequence[str] = (), root: str | None = None, key_buckets: int | None = None, **opts) -> dict:
    """Build or update table ``name`` from ``model`` (a DataFrame, or ``fn(spark, is_incremental) -> DataFrame``).

    Returns ``{"mode": ..., "rows_inserted": n}``.  Commits: ``append`` and a whole-partition
    overwrite are one write; a table rewrite is one new version and one switch; a scoped
    rewrite replaces its partitions in one write and then clears those left empty, so a
    failure between the two leaves rows that the next run clears.

    ``key_buckets`` (first build): store the table in that many buckets of ``unique_key``, as the
    partition column ``_key_bucket``.  A merge or delete+insert on that key then reads and
    rewrites the buckets of the delta's keys only.  Choose it so that a bucket is a few files;
    a table keeps its buckets until it is dropped.
    """
    layout = key_layout(spark, name)
    inc = is_incremental(spark, name, full_refresh)
    df = model(spark, inc) if callable(model) else model
    if not inc and (key_buckets or layout):
        bucket_keys, n_buckets = layout or (_keys(unique_key), key_buckets)
        if not bucket_keys or partition_by:
            raise ValueError("buckets need a unique_key and stand alone as partitions")
        layout, partition_by = (bucket_keys, n_buckets), [KEY_BUCKET]
    if layout:
        df = df.drop(KEY_BUCKET).withColumn(KEY_BUCKET, bucket_of(*layout))

    def keep_layout() -> None:  # a partitioned table is defined anew by a rewrite
        if layout:
            TB.set_properties(spark, name, bucket_keys=",".join(layout[0]), key_buckets=layout[1])

    if not inc:
        if TB.kind(spark, name) == "view":
            TB.drop(spark, name)
        seen = Observation()
        TB.write_version(df, name, root, partition_by, seen=seen)
        keep_layout()
        return {"mode": "full", "rows_inserted": seen.get["n"]}
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown incremental strategy {strategy!r}")
    target = spark.table(name)
    # what is computed from the target is frozen before the target changes; other deltas are
    # frozen further down, and only by strategies that read them more than once
    delta = df
    if strategy in ("append", "delete+insert") and reads_table(spark, df, name):
        delta = stable(df)
    target2, delta = SC.reconcile(target, delta, on_schema_change)
    parts = TB.partition_columns(spark, name)
    keys = _keys(unique_key)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    schema_changed = target2.columns != target.columns or target2.schema != target.schema
    whole = (not schema_changed and strategy == "delete+insert" and keys and parts and sorted(keys) == sorted(parts)
             and not predicates)
    adding = strategy == "append" and (not schema_changed or on_schema_change == "append_new_columns")
    seen = Observation()
    if adding:
        if schema_changed:
            added = [f for f in target2.schema.fields if f.name not in target.columns]
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
        if not parts and delta.isEmpty():  # else an empty file; without rows no partition gets any
            return {"mode": "append", "rows_inserted": 0}
        TB.append(delta, name, seen)
        return {"mode": "append", "rows_inserted": seen.get["n"]}
    if whole:
        # one pass writes and counts; a NULL key deletes nothing: such rows are a plain insert
        unkeyed = Observation()
        keyed = delta.observe(unkeyed, F.count(F.when(~nn, 1)).alias("n")).filter(nn)
        TB.overwrite_partitions(keyed, name, parts, seen)
        n = seen.get["n"]
        if unkeyed.get["n"]:
            null_rows = Observation()
            TB.append(delta.filter(~nn), name, null_rows)
            n += null_rows.get["n"]
        return {"mode": "partition_overwrite", "rows_inserted": n}
    delta = stable(delta)
    n = delta.count()
    if not schema_changed and layout and keys == layout[0] and strategy in ("delete+insert", "merge"):
        t_scope = touched_buckets(target2, delta)
        if strategy == "delete+insert":
            new = apply_delete_insert(t_scope, delta, keys, predicates)
        else:
            update = opts.get("merge_update_columns")
            new = apply_merge(t_scope, delta, keys, [*_keys(update), KEY_BUCKET] if update else None,
                              opts.get("merge_exclude_columns"), predicates)
        if n:
            TB.overwrite_partitions(stable(new), name, parts)
        return {"mode": "bucket_rewrite", "rows_inserted": n}
    scoped = (not schema_changed and parts and keys and strategy in ("delete+insert", "merge")
              and {p.lower() for p in parts} <= {k.lower() for k in keys})
    if scoped:
        # Every row the strategy can change shares its partition values with a delta row, so only
        # the delta's partitions are read (semi join -> dynamic partition pruning) and rewritten.
        t_scope = scope_to_partitions(target2, delta.select(*parts).distinct(), parts)
        if strategy == "delete+insert":
            new = apply_delete_insert(t_scope, delta, keys, predicates)
        else:
            new = apply_merge(t_scope, delta, keys, opts.get("merge_update_columns"),
                              opts.get("merge_exclude_columns"), predicates)
        TB.overwrite_partitions(stable(new), name, parts)  # frozen first: never read what is overwritten
        return {"mode": "partition_rewrite", "rows_inserted": n}
    if not schema_changed and parts and strategy == "microbatch" and opts.get("per_batch"):
        # one scoped rewrite per batch window: a failure loses only its batch, each job is one window
        batches = _rewrite_windows(spark, name, delta, parts, opts, n, root)
        return {"mode": "partition_rewrite", "rows_inserted": n, "batches": batches}
    if not schema_changed and parts and (strategy == "microbatch" or (
            strategy == "insert_overwrite" and predicates and not opts.get("whole_table", True))):
        done = _range_scoped_rewrite(spark, name, target2, delta, parts, strategy, predicates, opts, n)
        if done is not None:
            return done
    if strategy == "delete+insert":
        new = apply_delete_insert(target2, delta, keys, predicates)
    elif strategy == "merge":
        new = apply_merge(target2, delta, keys, opts.get("merge_update_columns"), opts.get("merge_exclude_columns"),
                          predicates)
    elif strategy == "insert_overwrite":
        new = apply_insert_overwrite(target2, delta, predicates, opts.get("columns"), opts.get("whole_table", True))
    elif strategy == "microbatch":
        new = apply_microbatch(target2, delta, opts["event_time"], opts["begin"], opts["end"],
                               opts.get("batch_size", "day"))
    else:
        new = apply_append(target2, delta)
    TB.write_version(new, name, root, parts)
    keep_layout()
    return {"mode": "rewrite", "rows_inserted": n}
