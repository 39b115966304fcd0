"""SCD type-2 snapshots.

One call turns ``(source, history)`` into the next history.  The change set is
derived from a *single* full outer join of the source with the open history
rows on the key: a joined row carries the one to three history rows that follow from
it (the open row kept or closed, a new version, a deletion record) and is exploded into
them, so the join runs once.  Rows with a NULL key -- which can never match -- bypass the
join, so a hot NULL key cannot pile up in one shuffle partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import scd_hash
from .incremental import duplicate_keys

META = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]
DELETED = "is_deleted"
#: Partition column of the closed part of a split history: the open version its rows were closed from.
CLOSED_FROM = "_closed_from"


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def _valid_to_current(valid_to_current) -> Column:
    return F.lit(None).cast("timestamp") if valid_to_current is None else F.lit(valid_to_current).cast("timestamp")


def _check_columns(source: DataFrame, keys: Sequence[str], check_cols, updated_at: str | None) -> list[str]:
    if check_cols in (None, "all"):
        return [c for c in source.columns if c not in keys and c != updated_at]
    return list(check_cols)


def snapshot(source: DataFrame, history: DataFrame | None, unique_key, strategy: str = "timestamp",
             updated_at: str | None = None, check_cols="all", hard_deletes: str = "ignore",
             valid_to_current=None, now=None, column_names: dict | None = None,
             check_duplicates: bool = True) -> DataFrame:
    """Next SCD2 history.

    * ``strategy='timestamp'``: a key changed iff its open row's ``valid_from``
      is older than the source ``updated_at``; the new version is stamped with it.
    * ``strategy='check'``: a key changed iff any ``check_cols`` value differs
      NULL-safely (a check column missing from the history marks every row
      changed); the new version is stamped with ``updated_at`` when given, else ``now``.
    * a key that comes twice in the source is an error once there is a history, as it is in a
      merge (``check_duplicates=False`` leaves that out);
    * changed keys: the open row is closed (``valid_to`` = new stamp) and a new
      open row is inserted; new keys are inserted.
    * ``hard_deletes``: ``ignore`` | ``invalidate`` (close open rows whose key left
      the source, at ``now``) | ``new_record`` (also add an open row with
      ``is_deleted='True'``).  Deletion records are not re-added on later runs
      while the key stays absent.
    * ``column_names`` renames the meta columns, e.g. ``{"valid_from": "effective_from"}``.
    """
    names = dict(column_names or {})
    if names:
        unknown = set(names) - set(META + [DELETED])
        if unknown:
            raise ValueError(f"unknown snapshot meta columns {sorted(unknown)}")
        if history is not None:
            history = history.withColumnsRenamed({v: k for k, v in names.items()})
        out = snapshot(source, history, unique_key, strategy, updated_at, check_cols, hard_deletes,
                       valid_to_current, now, check_duplicates=check_duplicates)
        return out.withColumnsRenamed(names)
    keys = _keys(unique_key)
    if strategy not in ("timestamp", "check"):
        raise ValueError(f"unknown snapshot strategy {strategy!r}")
    if strategy == "timestamp" and not updated_at:
        raise ValueError("timestamp strategy needs updated_at")
    if hard_deletes not in ("ignore", "invalidate", "new_record"):
        raise ValueError(f"unknown hard_deletes {hard_deletes!r}")
    now_c = _now(now)
    vt_cur = _valid_to_current(valid_to_current)
    src_cols = source.columns
    stamp_src = F.col(updated_at).cast("timestamp") if updated_at else now_c

    def fresh(df: DataFrame, stamp: Column) -> DataFrame:
        out = df.select(*src_cols, scd_hash(*keys, stamp).alias("scd_id"), stamp.alias("scd_updated_at"),
                        stamp.alias("valid_from"), vt_cur.alias("valid_to"))
        return out.withColumn(DELETED, F.lit("False")) if hard_deletes == "new_record" else out

    if history is None:
        return fresh(source, stamp_src)

    if check_duplicates and not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"snapshot source has duplicate rows for unique_key {keys}")
    hist_cols = history.columns
    if hard_deletes == "new_record" and DELETED not in hist_cols:
        history = history.withColumn(DELETED, F.lit("False"))
        hist_cols = history.columns
    # open rows: valid_to NULL (or the configured "current" sentinel, or NULL)
    open_cond = F.col("valid_to").isNull()
    if valid_to_current is not None:
        open_cond = open_cond | (F.col("valid_to") == vt_cur)
    current, closed = history.filter(open_cond), history.filter(~open_cond)

    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    s_keyed, s_null = source.filter(nn), source.filter(~nn)
    c_keyed, c_null = current.filter(nn), current.filter(~nn)

    checks = _check_columns(source, keys, check_cols, updated_at) if strategy == "check" else []
    new_cols = [c for c in checks if c not in hist_cols]

    s = s_keyed.select(*[F.col(c).alias(f"__s_{c}") for c in src_cols], F.lit(True).alias("__s"))
    c = c_keyed.select(*[F.col(x).alias(f"__c_{x}") for x in hist_cols], F.lit(True).alias("__c"))
    cond = None
    for k in keys:
        e = s[f"__s_{k}"] == c[f"__c_{k}"]
        cond = e if cond is None else cond & e
    j = s.join(c, cond, "full_outer")

    both = F.col("__s").isNotNull() & F.col("__c").isNotNull()
    only_s = F.col("__c").isNull()
    only_c = F.col("__s").isNull()
    if strategy == "timestamp":
        changed = F.col("__c_valid_from") < F.col(f"__s_{updated_at}").cast("timestamp")
    elif new_cols:
        changed = F.lit(True)
    else:
        changed = F.lit(False)
        for x in checks:
            changed = changed | ~F.col(f"__s_{x}").eqNullSafe(F.col(f"__c_{x}"))
    changed = F.coalesce(changed, F.lit(False))
    is_live = (F.col(f"__c_{DELETED}") != F.lit("True")) if hard_deletes == "new_record" else F.lit(True)
    gone = only_c & (F.lit(hard_deletes != "ignore")) & F.coalesce(is_live, F.lit(True))
    new_stamp = F.col(f"__s_{updated_at}").cast("timestamp") if updated_at else now_c

    # the columns and types of the next history, as a union of both sides has them (analysis only)
    shape = fresh(source.limit(0), stamp_src).unionByName(history.limit(0), allowMissingColumns=True)
    order = src_cols + [x for x in hist_cols if x not in src_cols and x not in META + [DELETED]] + META
    if DELETED in shape.columns:
        order.append(DELETED)
    kinds = {f.name: f.dataType for f in shape.schema.fields}

    def row(given: dict) -> Column:
        return F.struct(*[given.get(x, F.lit(None)).cast(kinds[x]).alias(x) for x in order])

    def when(cond: Column, given: dict) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), row(given))

    old = {x: F.col(f"__c_{x}") for x in hist_cols}
    # 1) open history rows, possibly closed now
    close_at = F.when(both & changed, new_stamp).when(gone, now_c)
    emit = [when(F.col("__c").isNotNull(), {**old, "valid_to": F.coalesce(close_at, F.col("__c_valid_to"))})]
    # 2) new versions: new keys, and changed keys
    version = {x: F.col(f"__s_{x}") for x in src_cols} | {
        "scd_id": scd_hash(*[F.col(f"__s_{k}") for k in keys], new_stamp), "scd_updated_at": new_stamp,
        "valid_from": new_stamp, "valid_to": vt_cur}
    if hard_deletes == "new_record":
        version[DELETED] = F.lit("False")
    emit.append(when(only_s | (both & changed), version))
    # 3) deletion records (new_record): an open row marking the key as deleted
    if hard_deletes == "new_record":
        emit.append(when(gone, {**old, "scd_id": scd_hash(F.col("__c_scd_id"), now_c), "scd_updated_at": now_c,
                                "valid_from": now_c, DELETED: F.lit("True")}))
    joined = j.select(F.explode(F.filter(F.array(*emit), lambda x: x.isNotNull())).alias("r")).select("r.*")
    parts = [closed, joined, fresh(s_null, stamp_src)]
    # NULL-key open rows never match the source
    if hard_deletes != "ignore":
        parts.append(c_null.withColumn("valid_to", F.coalesce(
            F.when(F.coalesce(F.col(DELETED) != "True", F.lit(True)) if hard_deletes == "new_record" else F.lit(True),
                   now_c), F.col("valid_to"))))
    else:
        parts.append(c_null)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*order)


def snapshot_table(spark, name: str, source: DataFrame, unique_key, root: str | None = None,
                   layout: str = "single", **opts) -> dict:
    """Materialize a snapshot run.

    * ``layout="single"``: the next history replaces table ``name`` as a new
      version (the version being read is never overwritten).
    * ``layout="split"``: closed versions live in ``{name}__closed`` (one partition per
      run), open versions in ``{name}__open`` (rewritten each run) and ``name`` is a view
      over both.  Closed rows never change, so a run reads and writes only the open
      rows plus what it closes: O(current keys + changes), not O(history).  A run that
      failed on the way can be repeated.
    The next history is frozen once before it is written, so ``now`` and every
    other input are evaluated a single time.
    """
    from . import incremental as INC
    from . import tables as TB

    names = dict(opts.get("column_names") or {})
    valid_to = names.get("valid_to", "valid_to")
    if layout == "single":
        history = spark.table(name) if TB.kind(spark, name) == "table" else None
        nxt = INC.stable(snapshot(source, history, unique_key, **opts))
        TB.write_version(nxt, name, root)
        return {"rows": spark.table(name).count()}
    if layout != "split":
        raise ValueError(f"unknown snapshot layout {layout!r}")
    open_t, closed_t = f"{name}__open", f"{name}__closed"
    history = spark.table(open_t) if TB.kind(spark, open_t) == "table" else None
    nxt = INC.stable(snapshot(source, history, unique_key, **opts))
    is_open = F.col(valid_to).isNull()
    if opts.get("valid_to_current") is not None:
        is_open = is_open | (F.col(valid_to) == F.lit(opts["valid_to_current"]).cast("timestamp"))
    # What a run closes is kept under the open version it was closed from.  If a run fails after
    # that write, the next one starts from the same open version and replaces the same partition.
    source_version = "initial" if history is None else TB.location(spark, open_t).rstrip("/").rsplit("/", 1)[-1]
    closed_now = nxt.filter(~is_open).withColumn(CLOSED_FROM, F.lit(source_version))
    if TB.kind(spark, closed_t) != "table":
        TB.write_version(closed_now, closed_t, root, partition_by=[CLOSED_FROM])
    elif set(closed_now.columns) == set(spark.table(closed_t).columns):
        TB.overwrite_partitions(closed_now, closed_t, [CLOSED_FROM])
    else:  # the history gained columns: rewrite the closed part once with the new layout
        before = spark.table(closed_t).filter(F.col(CLOSED_FROM) != source_version)
        TB.write_version(before.unionByName(closed_now, allowMissingColumns=True), closed_t, root, partition_by=[CLOSED_FROM])
    TB.write_version(nxt.filter(is_open), open_t, root)
    cols = ", ".join(f"`{c}`" for c in spark.table(open_t).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {cols} FROM {closed_t} UNION ALL SELECT {cols} FROM {open_t}")
    return {"rows": spark.table(name).count(), "closed_this_run": closed_now.count()}
