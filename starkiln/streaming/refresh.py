"""Derived tables kept fresh: batch refresh (full or incremental) and a streaming form with a target lag."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import incremental as INC
from ..operators import sinks
from ..operators import tables as TB


def refresh(spark: SparkSession, name: str, model: Callable[[SparkSession], DataFrame], mode: str = "full",
            root: str | None = None, **incremental_opts) -> dict:
    """Recompute table ``name`` from ``model``: ``full`` replaces it, ``incremental`` applies a strategy."""
    if mode == "full":
        sinks.as_table(model(spark), name, root=root)
        return {"mode": "full"}
    if mode == "incremental":
        return INC.incremental(spark, name, lambda s, inc: model(s), root=root, **incremental_opts)
    raise ValueError(f"unknown refresh mode {mode!r}")


def refresh_stream(source: DataFrame, name: str, checkpoint: str, target_lag: str = "1 minute",
                   transform: Callable[[DataFrame], DataFrame] | None = None, strategy: str | None = None,
                   unique_key=None, available_now: bool = False, key_buckets: int | None = None):
    """Streaming refresh: every ``target_lag`` the new source rows are transformed and applied
    to ``name`` with ``strategy``.

    The checkpoint hands every source row to exactly one committed micro-batch.
    Keyed strategies (``delete+insert``, ``merge``) are also idempotent if a batch
    is replayed after a failure between the table write and the checkpoint commit;
    ``append`` is then at-least-once, so pass a ``unique_key`` (the default strategy
    becomes ``merge``) when a replay must not duplicate rows.  With ``key_buckets`` a
    micro-batch rewrites the buckets of its keys instead of the table.
    """
    if strategy is None:
        strategy = "merge" if unique_key else "append"

    def apply(batch: DataFrame, epoch_id: int) -> None:
        out = transform(batch) if transform else batch
        INC.incremental(batch.sparkSession, name, out, strategy=strategy, unique_key=unique_key, key_buckets=key_buckets)

    w = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=target_lag)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


# -- tables with refresh settings --------------------------------------------------------------
INITIALIZE = ("on_create", "on_schedule")


def create_refreshed(spark: SparkSession, name: str, model: Callable[[SparkSession], DataFrame], target_lag: str,
                     mode: str = "full", initialize: str = "on_create", root: str | None = None) -> dict:
    """Create a table that :func:`refresh_if_due` keeps within ``target_lag`` (an interval such as
    ``'1 hour'``) of its sources.  ``on_create`` fills it now, ``on_schedule`` leaves it empty
    until the first refresh.  Settings are kept as table properties."""
    if initialize not in INITIALIZE:
        raise ValueError(f"unknown initialize {initialize!r}")
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown refresh mode {mode!r}")
    first = model(spark)
    sinks.as_table(first if initialize == "on_create" else first.limit(0), name, root=root)
    TB.set_properties(spark, name, target_lag=target_lag, refresh_mode=mode)
    if initialize == "on_create":
        TB.set_properties(spark, name, refreshed_at=_micros(spark))
    return {"initialized": initialize == "on_create"}


def alter_refreshed(spark: SparkSession, name: str, target_lag: str | None = None, mode: str | None = None) -> None:
    """Change the lag or the mode; the table's rows stay as they are."""
    if mode not in (None, "full", "incremental"):
        raise ValueError(f"unknown refresh mode {mode!r}")
    TB.set_properties(spark, name, target_lag=target_lag, refresh_mode=mode)


def _micros(spark: SparkSession) -> int:
    return spark.sql("select unix_micros(current_timestamp()) as m").first()["m"]


def refresh_if_due(spark: SparkSession, name: str, model: Callable[[SparkSession], DataFrame], root: str | None = None,
                   force: bool = False, **incremental_opts) -> dict:
    """Refresh ``name`` in its mode if its last refresh is longer ago than its lag (or never was)."""
    s = TB.properties(spark, name)
    now = _micros(spark)
    lag = spark.sql(f"select unix_micros(timestamp_micros({now}) + interval {s['target_lag']}) - {now} as m").first()["m"]
    if not force and "refreshed_at" in s and now - int(s["refreshed_at"]) < lag:
        return {"mode": "fresh"}
    mode = s["refresh_mode"]
    done = refresh(spark, name, model, mode, root=root, **(incremental_opts if mode == "incremental" else {}))
    TB.set_properties(spark, name, target_lag=s["target_lag"], refresh_mode=mode, refreshed_at=now)
    return done
