"""Registered queries: one per operator of the inventory, each over the driver tables.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose work
grows with the input tables.  Trip-shaped inputs come from
:mod:`starkiln.sources.driver_tables`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..operators import filters as FL
from ..operators import joins as J
from ..sources import driver_tables as D
from . import analytics as AN
from . import models as M

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# File days that the "second month" fixture holds in the target (up to and including day 20).
TARGET_CUTOFF = "2024-01-21"
# Files from this day on are reloaded in the reload fixture.
RELOAD_FROM = "2024-01-25"


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# -- shared derived relations -------------------------------------------------
def raw(spark, d):
    return D.raw_trips(spark, d)


def stg_all(spark, d):
    return M.stg_trips_renamed(raw(spark, d))


def stg(spark, d):
    return M.stg_trips(raw(spark, d))


def dim(spark, d):
    return M.dim_zones(M.stg_zones(D.raw_zones(spark, d)))


def fct(spark, d):
    return M.fct_trips(stg(spark, d), dim(spark, d))


def fct_target(spark, d):
    """The fact as it stood after the files up to day 20 were built."""
    return fct(spark, d).filter(F.col("_loaded_at") <= F.lit(TARGET_CUTOFF).cast("timestamp"))


def reloaded_raw(spark, d):
    """Raw rows plus a second, later copy of the files from ``RELOAD_FROM`` on (totals changed)."""
    r = raw(spark, d)
    again = (r.filter(F.col("tpep_pickup_datetime") >= F.lit(RELOAD_FROM).cast("timestamp_ntz"))
             .withColumn("total_amount", F.col("total_amount") + F.lit(1.0))
             .withColumn("_loaded_at", F.timestamp_add("HOUR", F.lit(6), F.col("_loaded_at"))))
    return r.unionByName(again)


def reload_delta(spark, d):
    """Staged rows of the second (later) load of the reloaded files."""
    r = reloaded_raw(spark, d)
    again = r.filter(F.col("tpep_pickup_datetime") >= F.lit(RELOAD_FROM).cast("timestamp_ntz"))
    return M.stg_trips(again, latest_only=True)


# -- 2.2 projections and filters ----------------------------------------------
@register("prj_01")
def prj_01(spark, d):
    return stg_all(spark, d)


@register("prj_02")
def prj_02(spark, d):
    return M.stg_zones(D.raw_zones(spark, d))


@register("prj_03")
def prj_03(spark, d):
    return dim(spark, d)


@register("prj_04")
def prj_04(spark, d):
    return fct(spark, d)


@register("flt_01")
def flt_01(spark, d):
    return FL.in_window(stg_all(spark, d), "pickup_at", "2024-01-10", "2024-01-20")


@register("flt_02")
def flt_02(spark, d):
    return stg_all(spark, d).filter(F.col("dropoff_at") > F.col("pickup_at"))


@register("flt_03")
def flt_03(spark, d):
    return stg_all(spark, d).filter((F.col("trip_distance_miles") > 0) & (F.col("total_amount") > 0))


@register("flt_04")
def flt_04(spark, d):
    f = fct(spark, d)
    return f.filter(F.col("payment_method").isin("Credit card", "Cash") & (F.col("is_weekend") == F.lit(False))
                    & F.col("avg_speed_mph").between(1, 60)).select(
        "trip_key", "pickup_at", "payment_method", "avg_speed_mph", "rate_type")


@register("flt_05")
def flt_05(spark, d):
    return FL.since_watermark(stg(spark, d), fct_target(spark, d), "_loaded_at")


@register("flt_05_empty_target")
def flt_05_empty_target(spark, d):
    return FL.since_watermark(stg(spark, d), fct_target(spark, d).filter(F.lit(False)), "_loaded_at")


@register("flt_06")
def flt_06(spark, d):
    s = M.stg_trips(reloaded_raw(spark, d), latest_only=True)
    return s.select("vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id", "total_amount", "_source_file",
                    "_loaded_at")


@register("flt_07")
def flt_07(spark, d):
    return FL.filter_audit(stg_all(spark, d), M.trip_rules())


@register("flt_08")
def flt_08(spark, d):
    return FL.minmax_profile(raw(spark, d), ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
                                             "total_amount", "passenger_count"])


@register("flt_10")
def flt_10(spark, d):
    f = fct(spark, d)
    return FL.preview(f.drop("_loaded_at"), 1000, order_by=[c for c in f.columns if c != "_loaded_at"])


# -- 2.3 joins -----------------------------------------------------------------
@register("jon_01")
def jon_01(spark, d):
    return fct(spark, d).select("trip_key", "pickup_zone_id", "pickup_borough", "pickup_zone",
                                "dropoff_zone_id", "dropoff_borough", "dropoff_zone")


@register("jon_02")
def jon_02(spark, d):
    return J.orphans(fct(spark, d), dim(spark, d), "pickup_zone_id", "zone_id").select(
        "trip_key", "pickup_zone_id", "_source_file")


@register("jon_03")
def jon_03(spark, d):
    return J.semi(fct(spark, d), reload_delta(spark, d), "_source_file").select("trip_key", "_source_file")


@register("jon_07")
def jon_07(spark, d):
    f = fct(spark, d)
    return f.select("trip_key", "pickup_zone_id", "dropoff_zone_id",
                    F.col("pickup_borough").eqNullSafe(F.col("dropoff_borough")).alias("same_borough_null_safe"),
                    (F.col("pickup_borough") == F.col("dropoff_borough")).alias("same_borough"))


# -- 2.4 aggregations ----------------------------------------------------------
@register("agg_01")
def agg_01(spark, d):
    return AN.tipping_by_borough(fct(spark, d))


@register("agg_01_min_trips_100")
def agg_01_min_trips_100(spark, d):
    return AN.tipping_by_borough(fct(spark, d), min_trips=100)


@register("agg_02")
def agg_02(spark, d):
    return AN.congestion_by_hour(fct(spark, d))


@register("agg_03")
def agg_03(spark, d):
    return AN.airport_economics(fct(spark, d))


@register("agg_04")
def agg_04(spark, d):
    t = fct_target(spark, d)
    return t.agg(A.coalesce_max("_loaded_at", F.lit("1900-01-01").cast("timestamp")).alias("watermark"),
                 A.coalesce_max(F.when(F.lit(False), F.col("_loaded_at")),
                                F.lit("1900-01-01").cast("timestamp")).alias("watermark_if_empty"))


@register("agg_05")
def agg_05(spark, d):
    return fct(spark, d).groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("n_records"))


@register("agg_07")
def agg_07(spark, d):
    return fct(spark, d).groupBy("pickup_zone_id").agg(A.any_value("pickup_borough").alias("borough"),
                                                      F.count(F.lit(1)).alias("trips"))


@register("agg_08")
def agg_08(spark, d):
    return fct(spark, d).groupBy("pickup_borough").agg(
        A.bool_or("is_weekend").alias("any_weekend"),
        A.bool_or(F.col("tip_amount") > 7).alias("any_big_tip"))


@register("agg_09")
def agg_09(spark, d):
    return fct(spark, d).groupBy("pickup_date").agg(
        F.expr("listagg(DISTINCT payment_method, ', ') WITHIN GROUP (ORDER BY payment_method)")
        .alias("payment_methods"))


@register("agg_10")
def agg_10(spark, d):
    return fct(spark, d).select("_source_file").distinct()


@register("agg_11")
def agg_11(spark, d):
    return AN.key_collision_rate(fct(spark, d))


# =============================================================================
# Sources, sinks, sets, incremental strategies, snapshots, quality tests,
# scalar functions, generators, streaming and UDFs.
# =============================================================================
import uuid as _uuid  # noqa: E402

from ..functions import dates as DT  # noqa: E402
from ..functions import generators as G  # noqa: E402
from ..functions import scalar as S  # noqa: E402
from ..operators import incremental as INC  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import schema_change as SCH  # noqa: E402
from ..operators import sinks as SK  # noqa: E402
from ..operators import snapshot as SCD  # noqa: E402
from ..schemas import ACCEPTED_BOROUGHS, FCT_TRIPS_COLUMNS, FCT_TRIPS_CONTRACT  # noqa: E402
from ..session import ensure_checkpoint_dir, scratch_path  # noqa: E402
from ..sources import ingest as ING  # noqa: E402
from ..sources import seeds as SEED  # noqa: E402
from . import udf as U  # noqa: E402

# Timestamps of the two snapshot runs and of the freshness check.
SNAPSHOT_T1 = "2024-01-01 00:00:00"
SNAPSHOT_T2 = "2024-02-01 00:00:00"
REPORT_TIME = "2024-02-01 00:00:00"


def _scratch(spark, kind: str) -> str:
    ensure_checkpoint_dir(spark)  # the session's spark.checkpoint.dir; a private one only if unset
    return scratch_path(spark, kind, _uuid.uuid4().hex)


def _tname(prefix: str) -> str:
    return f"{prefix}_{_uuid.uuid4().hex[:12]}"


def fct_delta(spark, d):
    """Fact rows of the files newer than the day-20 target (watermark delta)."""
    return M.fct_trips(FL.since_watermark(stg(spark, d), fct_target(spark, d)), dim(spark, d))


def fct_reload(spark, d):
    """Fact rows of the second load of the reloaded files."""
    return M.fct_trips(reload_delta(spark, d), dim(spark, d))


# -- 2.1 sources and sinks -------------------------------------------------------
@register("src_01")
def src_01(spark, d):
    return raw(spark, d)


@register("src_02")
def src_02(spark, d):
    ev = D.table(spark, d, "events").select("event_id")
    return ING.with_lineage(ev, loaded_at=F.lit(REPORT_TIME).cast("timestamp"), landing_root=d)


@register("src_03")
def src_03(spark, d):
    land = D.landing_trips(spark, d)
    cut = F.col("tpep_pickup_datetime") < F.lit("2024-01-16").cast("timestamp_ntz")
    old = land.filter(cut)
    new = land.filter(~cut).withColumnRenamed("Airport_fee", "airport_fee")
    # both spellings side by side, by position: the operator has to fold them
    names = [c for c in land.columns if c != "Airport_fee"]
    fee, none = F.col("fee"), F.lit(None).cast("double")
    both = old.withColumnRenamed("Airport_fee", "fee").select(*names, fee.alias("a"), none.alias("b")).unionByName(
        new.withColumnRenamed("airport_fee", "fee").select(*names, none.alias("a"), fee.alias("b")))
    both = both.toDF(*names, "Airport_fee", "airport_fee")
    return ING.ingest_trips(both).select("tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID", "Airport_fee")


@register("src_04")
def src_04(spark, d):
    land = D.landing_trips(spark, d)
    micros = land.withColumn("tpep_pickup_datetime", F.unix_micros(F.col("tpep_pickup_datetime").cast("timestamp"))) \
        .withColumn("tpep_dropoff_datetime", F.unix_micros(F.col("tpep_dropoff_datetime").cast("timestamp")))
    return ING.ingest_trips(micros).select("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount")


@register("src_05")
def src_05(spark, d):
    have = raw(spark, d).filter(F.col("_loaded_at") <= F.lit(TARGET_CUTOFF).cast("timestamp"))
    return ING.load_if_absent(have, raw(spark, d))


@register("src_06")
def src_06(spark, d):
    r = raw(spark, d)
    last = r.agg(F.max("_source_file").alias("f")).first()["f"]
    return ING.rows_loaded(r, last)


@register("src_07")
def src_07(spark, d):
    path = _scratch(spark, "zones_csv")
    D.raw_zones(spark, d).write.option("header", True).csv(path)
    return SEED.read_zones(spark, path)


@register("src_08")
def src_08(spark, d):
    b = raw(spark, d).agg(F.date_format(F.min("tpep_pickup_datetime"), "yyyy-MM").alias("lo"),
                          F.date_format(F.max("tpep_pickup_datetime"), "yyyy-MM").alias("hi")).first()
    months = ING.target_months(f"{b['lo']},{b['hi']}")
    return spark.createDataFrame([(m, f) for m, f in zip(months, ING.month_files(months))], "month string, file string")


@register("src_09")
def src_09(spark, d):
    path = _scratch(spark, "seed_csv")
    cust = D.table(spark, d, "customer").select(
        "c_custkey", "c_name", F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation_code"), "c_acctbal")
    cust.write.option("header", True).csv(path)
    return SEED.seed(spark, path, column_types={"nation_code": "string"})


@register("snk_01")
def snk_01(spark, d):
    return SK.as_view(fct(spark, d), _tname("v_fct_trips"))


@register("snk_02")
def snk_02(spark, d):
    return SK.as_table(fct(spark, d), _tname("fct_trips_tbl"), root=_scratch(spark, "wh"))


@register("snk_03")
def snk_03(spark, d):
    name = _tname("fct_trips_clustered")
    return SK.as_table(fct(spark, d), name, root=_scratch(spark, "wh"), cluster_by=["pickup_date", "pickup_zone_id"])


@register("snk_04")
def snk_04(spark, d):
    root = _scratch(spark, "wh")
    src = _tname("fct_src")
    SK.as_table(fct(spark, d), src, root=root, partition_by=["_source_file"])
    return SK.clone(spark, src, _tname("fct_clone"), root=root)


@register("snk_04_shallow")
def snk_04_shallow(spark, d):
    """A clone that shares the files of its source, after the source was written again."""
    root = _scratch(spark, "wh")
    src, dst = _tname("fct_src"), _tname("fct_shallow")
    SK.as_table(fct(spark, d), src, root=root, partition_by=["_source_file"])
    SK.clone(spark, src, dst, root=root, shallow=True)
    INC.incremental(spark, src, fct_reload(spark, d), "delete+insert", "_source_file")
    return spark.table(dst)


# -- 2.5 / 2.6 / 2.7 windows, sorts, sets ------------------------------------------
REGISTRY["win_01"] = REGISTRY["flt_06"]


@register("win_02")
def win_02(spark, d):
    f = fct(spark, d)
    b = f.agg(F.min("pickup_date").alias("lo"), F.date_add(F.max("pickup_date"), 1).alias("hi"))
    spine = G.spine_between(spark, b, "lo", "hi", "day", "day")
    daily = f.groupBy(F.col("pickup_date").alias("day")).agg(F.count(F.lit(1)).alias("trips"))
    return spine.join(daily, "day", "left").select("day", F.coalesce("trips", F.lit(0)).alias("trips"))


@register("srt_01")
def srt_01(spark, d):
    return fct(spark, d).select("pickup_borough", "pickup_hour", "trip_key").orderBy(
        F.col("pickup_borough").asc(), F.col("pickup_hour").desc(), "trip_key")


@register("srt_02")
def srt_02(spark, d):
    return Q.aggregated_unique(fct(spark, d), ["trip_key", "pickup_zone_id"]).orderBy(
        "column_name", F.col("n_records").desc())


@register("srt_03")
def srt_03(spark, d):
    return fct(spark, d).select("trip_key", "total_amount", "pickup_at").orderBy(
        F.col("total_amount").desc(), "trip_key", "pickup_at").limit(100)


@register("set_01")
def set_01(spark, d):
    return fct_target(spark, d).unionByName(fct_delta(spark, d))


@register("set_02")
def set_02(spark, d):
    return stg_all(spark, d).subtract(stg(spark, d))


@register("set_03")
def set_03(spark, d):
    cols = ["vendor_id", "pickup_at", "dropoff_at", "pickup_zone_id", "total_amount"]
    return M.stg_trips(reloaded_raw(spark, d)).select(*cols).intersect(stg(spark, d).select(*cols))


# -- 2.10 incremental strategies ---------------------------------------------------
@register("inc_01")
def inc_01(spark, d):
    return INC.apply_append(fct_target(spark, d), fct_delta(spark, d))


@register("inc_02")
def inc_02(spark, d):
    return INC.apply_delete_insert(fct(spark, d), fct_reload(spark, d), "_source_file")


@register("inc_02_watermark")
def inc_02_watermark(spark, d):
    return INC.apply_delete_insert(fct_target(spark, d), fct_delta(spark, d), "_source_file")


def _lineitem_delta(spark, d):
    li = D.table(spark, d, "lineitem")
    return li.filter(F.col("l_returnflag") == "R").withColumn("l_quantity", F.col("l_quantity") + 1)


@register("inc_02_composite")
def inc_02_composite(spark, d):
    li = D.table(spark, d, "lineitem")
    return INC.apply_delete_insert(li, _lineitem_delta(spark, d), ["l_orderkey", "l_linenumber"],
                                   predicates=["l_linestatus = 'F'"])


def _orders_delta(spark, d):
    o = D.table(spark, d, "orders")
    upd = o.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1) \
        .withColumn("o_orderpriority", F.lit("0-CHANGED"))
    key = F.col("o_orderkey")
    b = o.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()  # two scalars: where the keys of new rows begin
    moved, lo = key + F.lit(b["hi"]), min(b["lo"] or 0, (b["lo"] or 0) + (b["hi"] or 0))
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT")
    new = urgent.filter((key > 0) | key.isNull()).withColumn("o_orderkey", moved)
    # from 0 down the moved key may be one that upd has already: such a row goes below all keys
    taken = upd.select(key.alias("taken")).distinct()
    low = urgent.filter(key <= 0).join(taken, moved == F.col("taken"), "left")
    low = low.withColumn("o_orderkey", F.when(F.col("taken").isNull(), moved).otherwise(key + F.lit(lo - 1))).drop("taken")
    new = new.unionByName(low)
    return upd.unionByName(new)


@register("inc_03")
def inc_03(spark, d):
    return INC.apply_merge(D.table(spark, d, "orders"), _orders_delta(spark, d), "o_orderkey")


@register("inc_03_update_columns")
def inc_03_update_columns(spark, d):
    return INC.apply_merge(D.table(spark, d, "orders"), _orders_delta(spark, d), "o_orderkey",
                           update_columns=["o_totalprice"])


@register("inc_04")
def inc_04(spark, d):
    return INC.apply_insert_overwrite(fct_target(spark, d), fct_delta(spark, d))


@register("inc_04_predicates")
def inc_04_predicates(spark, d):
    return INC.apply_insert_overwrite(fct_target(spark, d), fct_delta(spark, d),
                                      predicates=["pickup_date >= date'2024-01-15'"], whole_table=False)


@register("inc_05")
def inc_05(spark, d):
    newer = M.fct_trips(M.stg_trips(reloaded_raw(spark, d), latest_only=True), dim(spark, d))
    return INC.apply_microbatch(fct(spark, d), newer, "pickup_at", "2024-01-25", "2024-02-01", "day")


@register("inc_05_concurrent")
def inc_05_concurrent(spark, d):
    """The windows of inc_05 as commits of their own, four at once."""
    name = _tname("fct_windows")
    newer = M.fct_trips(M.stg_trips(reloaded_raw(spark, d), latest_only=True), dim(spark, d))
    INC.incremental(spark, name, fct(spark, d), partition_by=["pickup_date"], root=_scratch(spark, "wh"))
    INC.incremental(spark, name, newer, "microbatch", event_time="pickup_at", begin="2024-01-25", end="2024-02-01",
                    batch_size="day", per_batch=True, concurrent=4)
    return spark.table(name)


@register("inc_06")
def inc_06(spark, d):
    strategy = INC.default_strategy()
    assert strategy == "merge"
    return INC.apply_merge(D.table(spark, d, "orders"), _orders_delta(spark, d), "o_orderkey")


@register("inc_07")
def inc_07(spark, d):
    return INC.stable(fct_delta(spark, d))


def _changed_delta(spark, d):
    return (fct_delta(spark, d).withColumn("tip_bucket", F.floor(F.col("tip_amount") / 3).cast("int"))
            .drop("airport_fee").withColumn("passenger_count", F.col("passenger_count").cast("string")))


def _schema_change(spark, d, mode):
    t, dl = SCH.reconcile(fct_target(spark, d), _changed_delta(spark, d), mode)
    return INC.apply_append(t, dl)


@register("inc_08_ignore")
def inc_08_ignore(spark, d):
    return _schema_change(spark, d, "ignore")


@register("inc_08_append_new_columns")
def inc_08_append_new_columns(spark, d):
    return _schema_change(spark, d, "append_new_columns")


@register("inc_08_sync_all_columns")
def inc_08_sync_all_columns(spark, d):
    return _schema_change(spark, d, "sync_all_columns")


@register("inc_09")
def inc_09(spark, d):
    name = _tname("fct_inc")
    root = _scratch(spark, "wh")
    INC.incremental(spark, name, fct_target(spark, d), partition_by=["_source_file"], root=root)
    INC.incremental(spark, name, fct(spark, d), full_refresh=True, partition_by=["_source_file"], root=root)
    return spark.table(name)


@register("inc_02_materialized")
def inc_02_materialized(spark, d):
    """The fact build as the pipeline runs it: first build, watermark delta, reload, empty rerun."""
    name = _tname("fct_trips")
    root = _scratch(spark, "wh")
    dm = dim(spark, d)

    def model(s, is_inc):
        src = stg(s, d)
        if is_inc:
            src = FL.since_watermark(src, s.table(name))
        return M.fct_trips(src, dm)

    first = M.fct_trips(stg(spark, d).filter(F.col("_loaded_at") <= F.lit(TARGET_CUTOFF).cast("timestamp")), dm)
    INC.incremental(spark, name, first, partition_by=["_source_file"], root=root)
    INC.incremental(spark, name, model, "delete+insert", "_source_file")
    INC.incremental(spark, name, fct_reload(spark, d), "delete+insert", "_source_file")
    rerun = INC.incremental(spark, name, model, "delete+insert", "_source_file")
    assert rerun["rows_inserted"] == 0, rerun
    return spark.table(name)


# -- 2.11 snapshots -----------------------------------------------------------------
def customer_v1(spark, d):
    c = D.table(spark, d, "customer")
    return c.filter(F.col("c_mktsegment") != "BUILDING").withColumn(
        "updated_at", F.lit(SNAPSHOT_T1).cast("timestamp"))


def customer_v2(spark, d):
    c = D.table(spark, d, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    chg = F.col("c_mktsegment") == "AUTOMOBILE"
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(chg, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    "c_mktsegment",
                    F.when(chg, F.lit(SNAPSHOT_T2)).otherwise(F.lit(SNAPSHOT_T1)).cast("timestamp").alias("updated_at"))


def _two_runs(spark, d, **kw):
    keys = kw.pop("unique_key", "c_custkey")
    h1 = SCD.snapshot(customer_v1(spark, d), None, keys, now=SNAPSHOT_T1, **kw)
    return SCD.snapshot(customer_v2(spark, d), h1, keys, now=SNAPSHOT_T2, **kw)


@register("scd_01")
def scd_01(spark, d):
    return _two_runs(spark, d, strategy="timestamp", updated_at="updated_at", hard_deletes="invalidate")


@register("scd_02")
def scd_02(spark, d):
    return _two_runs(spark, d, strategy="timestamp", updated_at="updated_at")


@register("scd_03")
def scd_03(spark, d):
    h1 = SCD.snapshot(customer_v1(spark, d).drop("updated_at"), None, "c_custkey", "check",
                      check_cols=["c_acctbal", "c_name"], now=SNAPSHOT_T1)
    return SCD.snapshot(customer_v2(spark, d).drop("updated_at"), h1, "c_custkey", "check",
                        check_cols=["c_acctbal", "c_name"], now=SNAPSHOT_T2)


@register("scd_04")
def scd_04(spark, d):
    return _two_runs(spark, d, strategy="timestamp", updated_at="updated_at", hard_deletes="new_record")


@register("scd_05")
def scd_05(spark, d):
    return scd_01(spark, d).select("c_custkey", "scd_id", "valid_from")


@register("scd_06")
def scd_06(spark, d):
    return _two_runs(spark, d, unique_key=["c_custkey", "c_nationkey"], strategy="timestamp",
                     updated_at="updated_at", hard_deletes="invalidate", valid_to_current="9999-12-31 00:00:00")


@register("scd_06_column_names")
def scd_06_column_names(spark, d):
    names = {"scd_id": "version_key", "scd_updated_at": "snapshot_at", "valid_from": "effective_from",
             "valid_to": "effective_to"}
    return _two_runs(spark, d, strategy="timestamp", updated_at="updated_at", hard_deletes="invalidate",
                     column_names=names)


# -- 2.12 data-quality tests ------------------------------------------------------------
@register("dq_01")
def dq_01(spark, d):
    return Q.not_null(fct(spark, d), "pickup_borough")


@register("dq_01_declared")
def dq_01_declared(spark, d):
    return Q.run_declared_tests(fct(spark, d), ["trip_key", "pickup_at", "total_amount"])


@register("dq_02")
def dq_02(spark, d):
    return Q.unique(fct(spark, d), "trip_key")


@register("dq_02_zone_id")
def dq_02_zone_id(spark, d):
    return Q.unique(dim(spark, d), "zone_id")


@register("dq_03")
def dq_03(spark, d):
    return Q.accepted_values(dim(spark, d), "borough", ACCEPTED_BOROUGHS)


@register("dq_03_fact")
def dq_03_fact(spark, d):
    return Q.accepted_values(fct(spark, d), "pickup_borough", ["AFRICA", "AMERICA", "ASIA"])


@register("dq_04")
def dq_04(spark, d):
    return Q.relationships(fct(spark, d), "pickup_zone_id", dim(spark, d), "zone_id")


@register("dq_05")
def dq_05(spark, d):
    return Q.aggregated_not_null(fct(spark, d), FCT_TRIPS_COLUMNS, skip=["_loaded_at"])


@register("dq_06")
def dq_06(spark, d):
    return Q.aggregated_unique(fct(spark, d), ["trip_key", "pickup_zone_id", "payment_method", "pickup_date"])


@register("dq_07")
def dq_07(spark, d):
    return Q.verdict(Q.not_null(fct(spark, d), "pickup_borough"))


@register("dq_07_custom")
def dq_07_custom(spark, d):
    return Q.verdict(Q.unique(fct(spark, d), "trip_key"), fail_calc="coalesce(sum(n_records), 0)",
                     warn_if="> 10", error_if="> 100000")


@register("dq_08")
def dq_08(spark, d):
    return Q.verdict_by_column(Q.aggregated_not_null(fct(spark, d), FCT_TRIPS_COLUMNS))


@register("dq_09")
def dq_09(spark, d):
    fails = Q.relationships(fct(spark, d), "pickup_zone_id", dim(spark, d), "zone_id")
    stored = Q.store_failures(fails, _tname("dq_relationships_failures"), "table", root=_scratch(spark, "wh"))
    return Q.verdict(stored)


@register("dq_10")
def dq_10(spark, d):
    cols = ["vendor_id", "pickup_at", "total_amount", "_source_file", "_loaded_at"]
    actual = M.stg_trips(reloaded_raw(spark, d))
    expected = M.stg_trips(reloaded_raw(spark, d), latest_only=True)
    return Q.unit_diff(actual, expected, cols)


@register("dq_12")
def dq_12(spark, d):
    f = fct(spark, d)
    return Q.assert_contract(f.select(*reversed(f.columns)), FCT_TRIPS_CONTRACT)


@register("dq_13")
def dq_13(spark, d):
    return Q.freshness(raw(spark, d), "_loaded_at", now=REPORT_TIME)


@register("dq_13_custom")
def dq_13_custom(spark, d):
    q = raw(spark, d).filter(F.col("VendorID") != 1).agg(F.max("_loaded_at").alias("m"))
    return Q.freshness_from(q, now=REPORT_TIME)


@register("dq_13_filtered")
def dq_13_filtered(spark, d):
    return Q.freshness(raw(spark, d), "_loaded_at", where="VendorID = 2", now=REPORT_TIME)


@register("dq_14")
def dq_14(spark, d):
    return Q.assert_rows(fct_delta(spark, d), at_least=1)


# -- 2.8 scalar functions ------------------------------------------------------------
@register("fn_01")
def fn_01(spark, d):
    return fct(spark, d).select("trip_key", "pickup_at", "total_amount")


@register("fn_02")
def fn_02(spark, d):
    return stg_all(spark, d).select("pickup_at", "dropoff_at", "trip_duration_seconds")


@register("fn_03_06")
def fn_03_06(spark, d):
    return fct(spark, d).select("pickup_at", "pickup_date", "pickup_hour", "pickup_day_name", "is_weekend")


@register("fn_07_09")
def fn_07_09(spark, d):
    return fct(spark, d).select("trip_key", "is_intra_borough", "payment_method", "rate_type", "tip_pct_of_fare",
                                "avg_speed_mph")


@register("fn_10_13")
def fn_10_13(spark, d):
    r = raw(spark, d)
    return r.select("passenger_count", S.float_to_int("passenger_count").alias("passenger_count_int"),
                    F.round(F.col("total_amount") / 3, 2).alias("third_total"),
                    F.coalesce("passenger_count", F.lit(-1.0)).alias("passenger_or_default"))


@register("fn_14_16")
def fn_14_16(spark, d):
    o = D.table(spark, d, "orders")
    return o.select("o_orderkey", S.cast("o_totalprice", "bigint").alias("price_bigint"),
                    S.safe_cast("o_orderpriority", "int").alias("priority_int"),
                    S.safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("priority_digit"),
                    S.bool_to_text(F.col("o_orderstatus") == "F").alias("is_final_text"))


@register("fn_17_23")
def fn_17_23(spark, d):
    c = D.table(spark, d, "customer")
    return c.select(
        "c_custkey",
        S.concat_strict("c_name", F.lit("/"), "c_mktsegment").alias("name_segment"),
        S.length("c_name").alias("name_len"),
        S.position("#", "c_name").alias("hash_pos"),
        S.replace("c_name", "Customer", "Cust").alias("short_name"),
        S.right("c_name", 4).alias("name_tail"),
        S.right("c_name", 0).alias("name_tail0"),
        S.split_part("c_name", "#", 2).alias("name_part2"),
        S.split_part("c_name", "#", -1).alias("name_part_last"),
        S.hash_text("c_custkey").alias("key_hash"),
    )


@register("fn_24_28")
def fn_24_28(spark, d):
    o = D.table(spark, d, "orders")
    od = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        DT.date_trunc("month", od).alias("order_month"),
        DT.dateadd("month", 1, od).alias("plus_month"),
        DT.dateadd("day", -3, od).alias("minus_3_days"),
        DT.datediff("year", od, F.lit("2000-01-01").cast("timestamp_ntz")).alias("years_to_2000"),
        DT.datediff("month", od, F.lit("2000-01-01").cast("timestamp_ntz")).alias("months_to_2000"),
        DT.datediff("day", od, F.lit("2000-01-01").cast("timestamp_ntz")).alias("days_to_2000"),
        DT.datediff("quarter", od, F.lit("2000-01-01").cast("timestamp_ntz")).alias("quarters_to_2000"),
        DT.datediff("hour", od, F.lit("2000-01-01 12:30:00").cast("timestamp_ntz")).alias("hours_to_2000"),
        DT.datediff("week", od, F.lit("2000-01-01").cast("timestamp_ntz")).alias("weeks_to_2000"),
        DT.datediff("minute", od, F.lit("2000-01-01 12:30:30").cast("timestamp_ntz")).alias("minutes_to_2000"),
        DT.datediff("second", od, F.lit("2000-01-01 12:30:30").cast("timestamp_ntz")).alias("seconds_to_2000"),
        DT.datediff("microsecond", od, F.lit("9999-12-30 00:00:00.000001").cast("timestamp_ntz")).alias("micros_to_9999"),
        DT.date_trunc("week", od).alias("order_week"),
        DT.dateadd("week", 2, F.to_date(od)).alias("due_date"),
        DT.last_day(od, "month").alias("month_end"),
        DT.last_day(od, "quarter").alias("quarter_end"),
        DT.last_day(od, "year").alias("year_end"),
        DT.make_date(F.year(od), F.month(od), 1).alias("month_start"),
    )


@register("fn_30_31")
def fn_30_31(spark, d):
    li = D.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        S.array_construct("l_quantity", "l_discount").alias("qty_disc"),
        S.array_append(S.array_construct("l_quantity"), F.col("l_tax")).alias("qty_tax"),
        S.array_concat(S.array_construct("l_quantity"), S.array_construct("l_extendedprice")).alias("qty_price"),
        S.scd_hash("l_orderkey", "l_linenumber", "l_returnflag").alias("scd_hash"),
    )


# -- 2.9 generators ---------------------------------------------------------------------
@register("gen_01")
def gen_01(spark, d):
    n = D.table(spark, d, "orders").count()
    return G.generate_series(spark, n)


@register("gen_02")
def gen_02(spark, d):
    b = D.table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"),
                                       F.to_date(F.max("o_orderdate")).alias("hi"))
    return G.spine_between(spark, b, "lo", "hi", "day", "date_day")


@register("gen_02_month")
def gen_02_month(spark, d):
    b = D.table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"),
                                       F.to_date(F.max("o_orderdate")).alias("hi"))
    return G.spine_between(spark, b, "lo", "hi", "month", "date_month")


@register("gen_03")
def gen_03(spark, d):
    b = D.table(spark, d, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("lo"),
                                       F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("hi")).first()
    return G.date_partitions(spark, f"{b['lo']},{b['hi']}")


# -- 2.13 streaming ---------------------------------------------------------------------
def _write_parts(trips, landing: str):
    """Several part files per source file; the returned call lands the late ones."""
    part = F.pmod(F.xxhash64("tpep_pickup_datetime", "PULocationID"), F.lit(3))

    def write(rows):
        rows.repartition(2).write.mode("append").partitionBy("_source_file").parquet(landing)

    write(trips.filter(part != 0))
    return lambda: write(trips.filter(part == 0))


@register("str_01")
def str_01(spark, d):
    base = _scratch(spark, "stream")
    landing = f"{base}/landing"
    late = _write_parts(D.landing_trips(spark, d), landing)
    schema = spark.read.parquet(landing).schema
    name = _tname("raw_trips_stream")
    from ..streaming import stream_ingest

    for step in range(3):  # several triggers; then late part files of known source files; then nothing new
        if step == 1:
            late()
        stream_ingest(spark, landing, name, f"{base}/checkpoint", schema, root=f"{base}/wh",
                      source_file_col="_source_file", max_files_per_trigger=20)
    return spark.table(name).drop("_source_path")


@register("str_02")
def str_02(spark, d):
    from ..streaming import refresh

    name = _tname("airport_economics")
    refresh(spark, name, lambda s: AN.airport_economics(fct(s, d)), mode="full", root=_scratch(spark, "wh"))
    return spark.table(name)


# -- 2.14 UDFs and Python models ----------------------------------------------------------
@register("udf_01")
def udf_01(spark, d):
    U.create_scalar(spark, "tip_pct", [("tip", "double"), ("fare", "double")], "double",
                    "round(tip / nullif(fare, 0) * 100, 2)")
    view = _tname("stg_trips_udf")
    stg(spark, d).createOrReplaceTempView(view)
    return spark.sql("select pickup_at, tip_amount, fare_amount, tip_pct(tip_amount, fare_amount) as tip_pct "
                     f"from {view}")


@register("udf_02")
def udf_02(spark, d):
    def model(ctx, s):
        f = ctx.ref("fct_trips")
        return f.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"),
                                            F.round(F.sum("total_amount"), 2).alias("revenue"))

    ctx = U.ModelContext(spark, _tname("daily_revenue"), refs={"fct_trips": fct(spark, d)}, root=_scratch(spark, "wh"))
    return U.run_model(spark, model, ctx)


# -- inventory rows composed from the operators above ------------------------------------
@register("flt_09")
def flt_09(spark, d):
    return Q.not_null(fct(spark, d), "pickup_borough", where="payment_method = 'Cash'")


def _current_v1(spark, d):
    h1 = SCD.snapshot(customer_v1(spark, d), None, "c_custkey", updated_at="updated_at", now=SNAPSHOT_T1)
    return h1.filter(F.col("valid_to").isNull())


@register("jon_04")
def jon_04(spark, d):
    """Source x open history, inner join on the key: the rows whose version changes."""
    cur = _current_v1(spark, d).select("c_custkey", "valid_from", F.col("c_acctbal").alias("old_acctbal"))
    v2 = customer_v2(spark, d)
    return v2.join(cur, "c_custkey", "inner").filter(F.col("valid_from") < F.col("updated_at")).select(
        "c_custkey", "old_acctbal", F.col("c_acctbal").alias("new_acctbal"), "updated_at")


@register("jon_05")
def jon_05(spark, d):
    """Source against open history, left (anti) joins both ways: new keys and vanished keys."""
    cur = _current_v1(spark, d).select("c_custkey")
    v2 = customer_v2(spark, d).select("c_custkey")
    ins = J.anti(v2, cur, "c_custkey").select("c_custkey", F.lit("insert").alias("change"))
    dele = J.anti(cur, v2, "c_custkey").select("c_custkey", F.lit("delete").alias("change"))
    return ins.unionByName(dele)


REGISTRY["jon_06"] = REGISTRY["gen_01"]


@register("agg_09_limit")
def agg_09_limit(spark, d):
    """Per pickup day, the three largest trips' keys (first-n listagg)."""
    from ..operators.aggregate import listagg_limited

    f = fct(spark, d)
    return listagg_limited(f, ["pickup_date"], "trip_key", [F.col("total_amount").desc(), F.col("trip_key")], 3,
                           "|", "top_trip_keys")


@register("agg_06")
def agg_06(spark, d):
    f = fct(spark, d).select(F.col("pickup_borough").alias("b"), F.col("payment_method").alias("p"))
    g = f.groupingSets([["b"], ["p"]], "b", "p").agg(
        F.when(F.grouping("b") == 0, F.lit("pickup_borough")).otherwise(F.lit("payment_method")).alias("grouped_by"),
        F.coalesce(F.col("b"), F.col("p")).alias("value"), F.count(F.lit(1)).alias("trips"))
    return g.select("grouped_by", "value", "trips")


@register("fn_29")
def fn_29(spark, d):
    r = raw(spark, d)
    return r.agg(F.count(F.when(F.col("_loaded_at") < DT.current_timestamp_utc(), 1)).alias("loaded_before_now"),
                 F.count(F.when(F.col("tpep_pickup_datetime") < DT.current_timestamp_ntz(), 1))
                 .alias("picked_up_before_now"))


@register("dq_suite")
def dq_suite(spark, d):
    """The seven declared tests of the marts, evaluated together."""
    f, z = fct(spark, d), dim(spark, d)
    return Q.run_tests([
        ("unique_dim_zones_zone_id", Q.unique(z, "zone_id")),
        ("not_null_dim_zones_zone_id", Q.not_null(z, "zone_id")),
        ("accepted_values_dim_zones_borough", Q.accepted_values(z, "borough", ACCEPTED_BOROUGHS)),
        ("not_null_fct_trips_trip_key", Q.not_null(f, "trip_key")),
        ("not_null_fct_trips_pickup_at", Q.not_null(f, "pickup_at")),
        ("not_null_fct_trips_total_amount", Q.not_null(f, "total_amount")),
        ("relationships_fct_trips_pickup_zone_id", Q.relationships(f, "pickup_zone_id", z, "zone_id")),
    ])


# The file that failed to load in the late-batch fixture.
LATE_FILE = "trips_2024-01-10.parquet"


@register("flt_05_per_file")
def flt_05_per_file(spark, d):
    """Per-file watermark: a file missing from the target (older load time than the target's max)
    is still picked up, where the global watermark would skip it for good."""
    target = fct_target(spark, d).filter(F.col("_source_file") != LATE_FILE)
    return FL.since_watermark(stg(spark, d), target, "_loaded_at", per_part="_source_file")


@register("scd_01_split")
def scd_01_split(spark, d):
    """scd_01 materialized: two runs written with the split layout, read back through its view."""
    name, root = _tname("customer_history"), _scratch(spark, "wh")
    kw = dict(strategy="timestamp", updated_at="updated_at", hard_deletes="invalidate")
    SCD.snapshot_table(spark, name, customer_v1(spark, d), "c_custkey", root=root, layout="split",
                       now=SNAPSHOT_T1, **kw)
    SCD.snapshot_table(spark, name, customer_v2(spark, d), "c_custkey", root=root, layout="split",
                       now=SNAPSHOT_T2, **kw)
    return spark.table(name)


@register("src_01_load")
def src_01_load(spark, d):
    """The load job over a landing folder with several part files per source file: first load, a
    load after late part files of known source files, a repeated load (nothing new), and a
    forced replace of every file (idempotent); the raw table is read back."""
    base = _scratch(spark, "load")
    late = _write_parts(D.landing_trips(spark, d).drop("_loaded_at"), f"{base}/landing")
    name = _tname("raw_trips_loaded")
    args = dict(root=f"{base}/wh", source_file_col="_source_file", replace=True)
    for step in range(4):
        if step == 1:
            late()
        ING.load_files(spark, f"{base}/landing", name, force=step == 3, **args)
    return spark.table(name).drop("_loaded_at", "_source_path")


# -- fixtures on which a broken operator fails -------------------------------------------
def _lines(spark, d):
    """Order lines under the key of a line; the key repeats in this data."""
    return D.table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip_key"), "l_quantity")


@register("dq_02_duplicates")
def dq_02_duplicates(spark, d):
    return Q.unique(_lines(spark, d), "trip_key")


@register("dq_07_custom_duplicates")
def dq_07_custom_duplicates(spark, d):
    return Q.verdict(Q.unique(_lines(spark, d), "trip_key"), fail_calc="coalesce(sum(n_records), 0)",
                     warn_if="> 10", error_if="> 100000000")


@register("agg_11_duplicates")
def agg_11_duplicates(spark, d):
    return AN.key_collision_rate(_lines(spark, d))


@register("scd_03_updated_at")
def scd_03_updated_at(spark, d):
    """Check strategy with an ``updated_at`` column: versions carry the source's stamp."""
    return _two_runs(spark, d, strategy="check", updated_at="updated_at", check_cols=["c_acctbal", "c_name"])


@register("scd_03_all")
def scd_03_all(spark, d):
    h1 = SCD.snapshot(customer_v1(spark, d).drop("updated_at"), None, "c_custkey", "check", now=SNAPSHOT_T1)
    return SCD.snapshot(customer_v2(spark, d).drop("updated_at"), h1, "c_custkey", "check", check_cols="all",
                        now=SNAPSHOT_T2)


@register("src_08_load")
def src_08_load(spark, d):
    """The backfill: month files written to a landing folder, the chosen months read back."""
    base = _scratch(spark, "months")
    land = D.landing_trips(spark, d).drop("_source_file", "_loaded_at")
    b = land.agg(F.date_format(F.min("tpep_pickup_datetime"), "yyyy-MM").alias("lo"),
                 F.date_format(F.max("tpep_pickup_datetime"), "yyyy-MM").alias("hi")).first()
    months = ING.target_months(f"{b['lo']},{b['hi']}")
    for m in months:
        land.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == m).write.parquet(f"{base}/trips_{m}.parquet")
    got = ING.load_months(spark, base, months)
    return got.groupBy(F.split("_source_file", "/")[0].alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("VendorID").alias("vendor_sum"), F.max("tpep_pickup_datetime").alias("last_pickup"))


@register("inc_03_exclude_columns")
def inc_03_exclude_columns(spark, d):
    return INC.apply_merge(D.table(spark, d, "orders"), _orders_delta(spark, d), "o_orderkey",
                           exclude_columns=["o_orderpriority"])


@register("inc_06_default")
def inc_06_default(spark, d):
    """The default strategy of a stored table, dispatched by the materialization."""
    name = _tname("orders_default")
    INC.incremental(spark, name, D.table(spark, d, "orders"), root=_scratch(spark, "wh"))
    INC.incremental(spark, name, _orders_delta(spark, d), INC.default_strategy(), "o_orderkey")
    return spark.table(name)


def _schema_change_stored(spark, d, mode):
    name = _tname("fct_evolved")
    INC.incremental(spark, name, fct_target(spark, d), root=_scratch(spark, "wh"))
    INC.incremental(spark, name, _changed_delta(spark, d), "append", on_schema_change=mode)
    return spark.table(name)


@register("inc_08_append_new_columns_stored")
def inc_08_append_new_columns_stored(spark, d):
    return _schema_change_stored(spark, d, "append_new_columns")


@register("inc_08_sync_all_columns_stored")
def inc_08_sync_all_columns_stored(spark, d):
    return _schema_change_stored(spark, d, "sync_all_columns")


@register("str_02_incremental")
def str_02_incremental(spark, d):
    from ..streaming import refresh

    name = _tname("fct_refreshed")
    refresh(spark, name, lambda s: fct_target(s, d), mode="full", root=_scratch(spark, "wh"))
    refresh(spark, name, lambda s: fct_delta(s, d), mode="incremental", strategy="append")
    return spark.table(name)


@register("str_02_stream")
def str_02_stream(spark, d):
    """A table refreshed by a stream: new rows of a growing folder are merged by key."""
    from ..streaming import refresh_stream

    base, name = _scratch(spark, "lag"), _tname("orders_refreshed")
    o = D.table(spark, d, "orders")
    for part in (o, o.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)):
        part.write.mode("append").parquet(f"{base}/landing")
        refresh_stream(spark.readStream.schema(o.schema).parquet(f"{base}/landing"), name, f"{base}/checkpoint",
                       unique_key="o_orderkey", available_now=True)
    return spark.table(name)


# -- files as they come: several vintages, changed files ------------------------------------
def _write_file(df, path: str) -> None:
    """``df`` as the one Parquet file ``path`` (an earlier file of the name is replaced)."""
    spark = df.sparkSession
    df.coalesce(1).write.parquet(f"{path}.dir")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(x.getPath() for x in fs.listStatus(hadoop.Path(f"{path}.dir")) if x.getPath().getName().endswith(".parquet"))
    fs.mkdirs(hadoop.Path(path).getParent())
    fs.delete(hadoop.Path(path), False)
    fs.rename(part, hadoop.Path(path))
    fs.delete(hadoop.Path(f"{path}.dir"), True)


# First days of the second and the third vintage of the drift fixture.
DRIFT_FROM = ("2024-01-11", "2024-01-21")


@register("src_01_drift")
def src_01_drift(spark, d):
    """One load over files of three vintages: counts as doubles, as 64-bit integers with the other
    spelling of the fee, and times as epoch microseconds."""
    base, name = _scratch(spark, "drift"), _tname("raw_trips_drift")
    land = D.landing_trips(spark, d).drop("_loaded_at")
    at = [F.lit(x).cast("timestamp_ntz") for x in DRIFT_FROM]
    ts = F.col("tpep_pickup_datetime")
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    old, mid, new = land.filter(ts < at[0]), land.filter((ts >= at[0]) & (ts < at[1])), land.filter(ts >= at[1])
    mid = mid.withColumns({c: F.col(c).cast("bigint") for c in ("passenger_count", "RatecodeID")})
    for part in (old, mid.withColumnRenamed("Airport_fee", "airport_fee"), new.withColumns(micros)):
        part.repartition("_source_file").write.mode("append").partitionBy("_source_file").parquet(f"{base}/landing")
    ING.load_files(spark, f"{base}/landing", name, root=f"{base}/wh", source_file_col="_source_file")
    return spark.table(name).drop("_loaded_at", "_source_path")


# Files of the changed-file fixture hold trips up to, and from, this day.
CHANGED_FROM = "2024-01-16"


def _changed_landing(spark, d, base):
    """Two files with a blank and a per cent sign in their names; the returned call replaces the
    second one under its name, with fewer rows and other totals."""
    land = D.landing_trips(spark, d).drop("_loaded_at", "_source_file")
    late = F.col("tpep_pickup_datetime") >= F.lit(CHANGED_FROM).cast("timestamp_ntz")
    _write_file(land.filter(~late), f"{base}/landing/trips first.parquet")
    _write_file(land.filter(late), f"{base}/landing/trips 100%.parquet")

    def replace():
        fewer = land.filter(late & (F.col("payment_type") != 0))
        _write_file(fewer.withColumn("total_amount", F.col("total_amount") + 1), f"{base}/landing/trips 100%.parquet")
    return replace


@register("src_05_changed")
def src_05_changed(spark, d):
    """A file replaced under its name is loaded again, an unchanged one is not."""
    base, name = _scratch(spark, "changed"), _tname("raw_trips_changed")
    replace = _changed_landing(spark, d, base)
    ING.load_files(spark, f"{base}/landing", name, root=f"{base}/wh")
    replace()
    again = ING.load_files(spark, f"{base}/landing", name, root=f"{base}/wh").collect()
    assert [r["_source_file"] for r in again] == ["trips 100%.parquet"], again
    return spark.table(name).drop("_loaded_at", "_source_path")


@register("str_01_changed")
def str_01_changed(spark, d):
    """The stream over the same folder: the replaced file takes the place of the earlier one."""
    from ..streaming import stream_ingest

    base, name = _scratch(spark, "changed-stream"), _tname("raw_trips_changed_stream")
    replace = _changed_landing(spark, d, base)
    schema = D.landing_trips(spark, d).drop("_loaded_at", "_source_file").schema
    for step in range(2):
        if step:
            replace()
        stream_ingest(spark, f"{base}/landing", name, f"{base}/checkpoint", schema, root=f"{base}/wh")
    return spark.table(name).drop("_loaded_at", "_source_path")


@register("str_02_aggregate")
def str_02_aggregate(spark, d):
    """Airport economics kept up to date from partials per file: first build, then a wrong file
    replaced and a new one added, then one removed.  Only the files concerned are read."""
    from ..sources import ledger as LG
    from ..streaming import Measure, maintain_aggregate

    base, raw_t, name = _scratch(spark, "maintained"), _tname("raw_trips_agg"), _tname("airport_economics_kept")
    landing = f"{base}/landing"
    land = D.landing_trips(spark, d).drop("_loaded_at", "_source_file")
    third = F.dayofmonth("tpep_pickup_datetime") % 3
    files = {f"trips part {i}.parquet": land.filter(third == i) for i in range(3)}
    measures = [Measure("trips", "count"), Measure("avg_miles", "avg", "trip_distance_miles", 2),
                Measure("avg_minutes", "avg", "trip_duration_minutes", 1), Measure("avg_total", "avg", "total_amount", 2)]

    def run() -> dict:
        ING.load_files(spark, landing, raw_t, root=f"{base}/wh")
        now = LG.listing(spark, [landing], landing).select(
            F.col("_source_path").alias("_source_file"), F.concat_ws("/", "length", F.unix_micros("modified")).alias("version"))
        f = M.fct_trips(M.stg_trips(spark.table(raw_t)), dim(spark, d)).filter(F.col("rate_type").isin("Standard", "JFK", "Newark"))
        return maintain_aggregate(spark, name, f, "_source_file", ["rate_type"], measures, now, root=f"{base}/wh")

    a, b, c = files
    _write_file(files[a], f"{landing}/{a}")
    _write_file(files[b].withColumn("total_amount", F.col("total_amount") + 7).filter("payment_type <> 1"), f"{landing}/{b}")
    _write_file(files[c], f"{landing}/gone.parquet")
    assert run() == {"mode": "initial", "parts_read": 3}
    _write_file(files[b], f"{landing}/{b}")
    _write_file(files[c], f"{landing}/{c}")
    assert run() == {"mode": "incremental", "parts_read": 2}
    hadoop = spark._jvm.org.apache.hadoop.fs
    gone = hadoop.Path(f"{landing}/gone.parquet")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, False)
    assert run() == {"mode": "incremental", "parts_read": 0} and run() == {"mode": "noop", "parts_read": 0}
    return spark.table(name)


@register("inc_03_buckets")
def inc_03_buckets(spark, d):
    """A merge on a key that is no partition: the table is stored in buckets of the key."""
    name = _tname("orders_buckets")
    INC.incremental(spark, name, D.table(spark, d, "orders"), unique_key="o_orderkey", key_buckets=16, root=_scratch(spark, "wh"))
    done = INC.incremental(spark, name, _orders_delta(spark, d), "merge", "o_orderkey")
    assert done["mode"] == "bucket_rewrite", done
    return spark.table(name).drop(INC.KEY_BUCKET)


@register("inc_02_buckets")
def inc_02_buckets(spark, d):
    """delete+insert on a composite key in buckets; key tuples repeat in this table."""
    name, keys = _tname("lines_buckets"), ["l_orderkey", "l_linenumber"]
    INC.incremental(spark, name, D.table(spark, d, "lineitem"), unique_key=keys, key_buckets=16, root=_scratch(spark, "wh"))
    INC.incremental(spark, name, _lineitem_delta(spark, d), "delete+insert", keys, predicates=["l_linestatus = 'F'"])
    return spark.table(name).drop(INC.KEY_BUCKET)


@register("str_02_stream_buckets")
def str_02_stream_buckets(spark, d):
    """str_02_stream with the table in buckets of its key: a micro-batch rewrites its own."""
    from ..streaming import refresh_stream

    base, name = _scratch(spark, "lag"), _tname("orders_refreshed_buckets")
    o = D.table(spark, d, "orders")
    for part in (o, o.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)):
        part.write.mode("append").parquet(f"{base}/landing")
        refresh_stream(spark.readStream.schema(o.schema).parquet(f"{base}/landing"), name, f"{base}/checkpoint",
                       unique_key="o_orderkey", available_now=True, key_buckets=16)
    return spark.table(name).drop(INC.KEY_BUCKET)
