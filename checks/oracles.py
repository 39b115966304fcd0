"""DuckDB oracle SQL, one per registered query (same keys, same column names)."""

from __future__ import annotations

from .base_sql import q

TARGET_CUTOFF = "timestamp '2024-01-21'"
RELOAD_FROM = "timestamp '2024-01-25'"

ORACLES: dict[str, str] = {}

STG_COLS = ("vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance_miles, rate_code_id, store_and_fwd_flag, "
            "pickup_zone_id, dropoff_zone_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
            "improvement_surcharge, congestion_surcharge, airport_fee, total_amount, trip_duration_seconds, "
            "_source_file, _loaded_at")

FCT_TARGET = f"fct_target as (select * from fct_trips where _loaded_at <= {TARGET_CUTOFF})"
DELTA = f"delta as (select * from stg_trips where _loaded_at > (select coalesce(max(_loaded_at), timestamp '1900-01-01') from fct_target))"

ORACLES["prj_01"] = q("select * from stg_renamed")
ORACLES["prj_02"] = q("select * from stg_zones")
ORACLES["prj_03"] = q("select * from dim_zones")
ORACLES["prj_04"] = q("select * from fct_trips")
ORACLES["flt_01"] = q("select * from stg_renamed where pickup_at >= timestamp '2024-01-10' and pickup_at < timestamp '2024-01-20'")
ORACLES["flt_02"] = q("select * from stg_renamed where dropoff_at > pickup_at")
ORACLES["flt_03"] = q("select * from stg_renamed where trip_distance_miles > 0 and total_amount > 0")
ORACLES["flt_04"] = q("""select trip_key, pickup_at, payment_method, avg_speed_mph, rate_type from fct_trips
where payment_method in ('Credit card', 'Cash') and is_weekend = false and avg_speed_mph between 1 and 60""")
ORACLES["flt_05"] = q("select * from delta", FCT_TARGET + "," + DELTA)
ORACLES["flt_05_empty_target"] = q(
    "select * from stg_trips where _loaded_at > (select coalesce(max(_loaded_at), timestamp '1900-01-01') "
    "from fct_trips where false)")
ORACLES["flt_06"] = q(f"""
select vendor_id, pickup_at, dropoff_at, pickup_zone_id, total_amount, _source_file, _loaded_at from (
  select *, max(_loaded_at) over (partition by _source_file) as mx from stg_reload
) where _loaded_at = mx""", f"""
raw_reload as (
  select * from raw_trips
  union all
  select * replace (total_amount + 1 as total_amount, _loaded_at + interval 6 hour as _loaded_at)
  from raw_trips where tpep_pickup_datetime >= {RELOAD_FROM}
),
stg_reload as (
  select VendorID as vendor_id, tpep_pickup_datetime as pickup_at, tpep_dropoff_datetime as dropoff_at,
    trip_distance as trip_distance_miles, PULocationID as pickup_zone_id, total_amount, _source_file, _loaded_at
  from raw_reload
  where tpep_pickup_datetime >= timestamp '2024-01-01' and tpep_pickup_datetime < timestamp '2025-01-01'
    and tpep_dropoff_datetime > tpep_pickup_datetime and trip_distance > 0 and total_amount > 0
)""")
ORACLES["flt_07"] = q("""
select rule, cast(n_rows as bigint) as n_rows, round(n_rows * 100.0 / total, 1) as pct_of_total from (
  select 'total' as rule, count(*) as n_rows, (select count(*) from f) as total from f
  union all select 'kept', sum(case when ok1 and ok2 and ok3 and ok4 then 1 else 0 end), (select count(*) from f) from f
  union all select 'pickup_in_window', sum(case when ok1 then 0 else 1 end), (select count(*) from f) from f
  union all select 'dropoff_after_pickup', sum(case when ok2 then 0 else 1 end), (select count(*) from f) from f
  union all select 'positive_distance', sum(case when ok3 then 0 else 1 end), (select count(*) from f) from f
  union all select 'positive_total', sum(case when ok4 then 0 else 1 end), (select count(*) from f) from f
  union all select 'dropped', count(*) - sum(case when ok1 and ok2 and ok3 and ok4 then 1 else 0 end),
    (select count(*) from f) from f
)""", """
f as (
  select coalesce(pickup_at >= timestamp '2024-01-01' and pickup_at < timestamp '2025-01-01', false) as ok1,
    coalesce(dropoff_at > pickup_at, false) as ok2, coalesce(trip_distance_miles > 0, false) as ok3,
    coalesce(total_amount > 0, false) as ok4
  from stg_renamed
)""")
ORACLES["flt_08"] = q("""
select min(tpep_pickup_datetime) as tpep_pickup_datetime_min, max(tpep_pickup_datetime) as tpep_pickup_datetime_max,
  min(tpep_dropoff_datetime) as tpep_dropoff_datetime_min, max(tpep_dropoff_datetime) as tpep_dropoff_datetime_max,
  min(trip_distance) as trip_distance_min, max(trip_distance) as trip_distance_max,
  min(total_amount) as total_amount_min, max(total_amount) as total_amount_max,
  min(passenger_count) as passenger_count_min, max(passenger_count) as passenger_count_max
from raw_trips""")
_FCT_NO_LOADED = ("trip_key, pickup_at, dropoff_at, pickup_date, pickup_hour, pickup_day_name, is_weekend, pickup_zone_id, "
                  "pickup_borough, pickup_zone, dropoff_zone_id, dropoff_borough, dropoff_zone, is_intra_borough, "
                  "passenger_count, trip_distance_miles, trip_duration_seconds, trip_duration_minutes, avg_speed_mph, "
                  "fare_amount, tip_amount, tolls_amount, congestion_surcharge, airport_fee, total_amount, "
                  "tip_pct_of_fare, payment_method, rate_type, _source_file")
ORACLES["flt_10"] = q(f"select {_FCT_NO_LOADED} from fct_trips order by "
                      + ", ".join(c.strip() + " asc nulls first" for c in _FCT_NO_LOADED.split(",")) + " limit 1000")
ORACLES["jon_01"] = q("select trip_key, pickup_zone_id, pickup_borough, pickup_zone, dropoff_zone_id, dropoff_borough, "
                      "dropoff_zone from fct_trips")
ORACLES["jon_02"] = q("""select c.trip_key, c.pickup_zone_id, c._source_file from fct_trips c
left join dim_zones p on c.pickup_zone_id = p.zone_id where c.pickup_zone_id is not null and p.zone_id is null""")
ORACLES["jon_03"] = q(f"select trip_key, _source_file from fct_trips where _source_file in "
                      f"(select _source_file from stg_trips where pickup_at >= {RELOAD_FROM})")
ORACLES["jon_07"] = q("""select trip_key, pickup_zone_id, dropoff_zone_id,
  pickup_borough is not distinct from dropoff_borough as same_borough_null_safe,
  pickup_borough = dropoff_borough as same_borough from fct_trips""")
def _per_group(keys: list[str], where: str, means: dict, min_trips: int = 0) -> str:
    """Per group: number of trips and means, from sums and counts of the known values.
    ``means``: output name -> (column, decimal places)."""
    parts = ", ".join(f"sum({c}) as sum_{n}, count({c}) as known_{n}" for n, (c, _) in means.items())
    out = ", ".join(f"round(sum_{n} / known_{n}, {d}) as {n}" for n, (_, d) in means.items())
    names = ", ".join(keys)
    return q(f"select {names}, trips, {out} from (select {names}, count(*) as trips, {parts} from fct_trips "
             f"where {where} group by {names}) as g where trips > {min_trips}")


# Thresholds and groups of the three reports.
_TIPPED, _SPEEDS, _FARES = "payment_method in ('Credit card', 'Cash')", (1, 60), "rate_type in ('Standard', 'JFK', 'Newark')"
_TIPS = {"avg_tip_pct": ("tip_pct_of_fare", 1), "avg_fare": ("total_amount", 2)}
ORACLES["agg_01"] = _per_group(["pickup_borough", "payment_method"], _TIPPED, _TIPS, min_trips=1000)
ORACLES["agg_01_min_trips_100"] = _per_group(["pickup_borough", "payment_method"], _TIPPED, _TIPS, min_trips=100)
ORACLES["agg_02"] = _per_group(["pickup_borough", "pickup_hour"],
                               f"not is_weekend and avg_speed_mph >= {_SPEEDS[0]} and avg_speed_mph <= {_SPEEDS[1]}",
                               {"mph": ("avg_speed_mph", 1)})
ORACLES["agg_03"] = _per_group(["rate_type"], _FARES, {
    "avg_miles": ("trip_distance_miles", 2), "avg_minutes": ("trip_duration_minutes", 1), "avg_total": ("total_amount", 2)})
ORACLES["agg_04"] = q("""select coalesce(max(_loaded_at), timestamp '1900-01-01') as watermark,
  coalesce(max(case when false then _loaded_at end), timestamp '1900-01-01') as watermark_if_empty
from fct_target""", FCT_TARGET)
ORACLES["agg_05"] = q("select pickup_borough, count(*) as n_records from fct_trips group by 1")
ORACLES["agg_07"] = q("select pickup_zone_id, any_value(pickup_borough) as borough, count(*) as trips "
                      "from fct_trips group by 1")
ORACLES["agg_08"] = q("select pickup_borough, bool_or(is_weekend) as any_weekend, bool_or(tip_amount > 7) as any_big_tip "
                      "from fct_trips group by 1")
ORACLES["agg_09"] = q("select pickup_date, string_agg(distinct payment_method, ', ' order by payment_method) "
                      "as payment_methods from fct_trips group by 1")
ORACLES["agg_10"] = q("select distinct _source_file from fct_trips")
ORACLES["agg_11"] = q("""
select cast(sum(n) as bigint) as total_rows, cast(coalesce(sum(case when trip_key is null then n end), 0) as bigint) as null_keys,
  count(trip_key) as distinct_keys, count(case when trip_key is not null and n > 1 then 1 end) as colliding_keys,
  cast(coalesce(sum(case when trip_key is not null and n > 1 then n end), 0) as bigint) as rows_in_collisions,
  round((sum(n) - coalesce(sum(case when trip_key is null then n end), 0) - count(trip_key)) * 100.0
        / nullif(sum(n) - coalesce(sum(case when trip_key is null then n end), 0), 0), 4) as collision_pct
from (select trip_key, count(*) as n from fct_trips group by 1)""")


# =============================================================================
# Sources, sinks, sets, incremental, snapshots, quality, functions, generators,
# streaming, UDFs.
# =============================================================================
from .base_sql import fct_from, stg_from  # noqa: E402

FCT_COLS = ["trip_key", "pickup_at", "dropoff_at", "pickup_date", "pickup_hour", "pickup_day_name", "is_weekend",
            "pickup_zone_id", "pickup_borough", "pickup_zone", "dropoff_zone_id", "dropoff_borough", "dropoff_zone",
            "is_intra_borough", "passenger_count", "trip_distance_miles", "trip_duration_seconds",
            "trip_duration_minutes", "avg_speed_mph", "fare_amount", "tip_amount", "tolls_amount",
            "congestion_surcharge", "airport_fee", "total_amount", "tip_pct_of_fare", "payment_method", "rate_type",
            "_source_file", "_loaded_at"]
T1, T2 = "timestamp '2024-01-01 00:00:00'", "timestamp '2024-02-01 00:00:00'"

# relations shared by several oracles
RAW_AGAIN = f"""
raw_again as (
  select * replace (total_amount + 1 as total_amount, _loaded_at + interval 6 hour as _loaded_at)
  from raw_trips where tpep_pickup_datetime >= {RELOAD_FROM}
),
raw_reload as (select * from raw_trips union all select * from raw_again)"""
DELTA_FCT = FCT_TARGET + "," + DELTA + "," + fct_from("fct_delta", "delta")
RELOAD_FCT = RAW_AGAIN + "," + stg_from("stg_again", "raw_again") + "," + fct_from("fct_reload", "stg_again")
O_DELTA = """
o_delta as (
  select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate,
    '0-CHANGED' as o_orderpriority
  from orders where o_orderstatus = 'F'
  union all
  select o_orderkey + (select max(o_orderkey) from orders), o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority
  from orders where o_orderpriority = '1-URGENT'
)"""
FCT_ALL = "select * from fct_trips"


def _fct_cols(overrides: dict | None = None, drop=(), add=()) -> str:
    ov = overrides or {}
    cols = [f"{ov[c]} as {c}" if c in ov else c for c in FCT_COLS if c not in drop]
    return ", ".join(cols + list(add))


# -- sources and sinks
ORACLES["src_01"] = q("select * from raw_trips")
ORACLES["src_02"] = q("select event_id, 'events.parquet' as _source_file, timestamp '2024-02-01 00:00:00' as _loaded_at "
                      "from events")
ORACLES["src_03"] = q("select tpep_pickup_datetime, tpep_dropoff_datetime, VendorID, Airport_fee from raw_trips")
ORACLES["src_04"] = q("select VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount from raw_trips")
ORACLES["src_05"] = q(f"select * from raw_trips where _source_file not in "
                      f"(select distinct _source_file from raw_trips where _loaded_at <= {TARGET_CUTOFF})")
ORACLES["src_06"] = q("select count(*) as rows_loaded from raw_trips "
                      "where ends_with(_source_file, (select max(_source_file) from raw_trips))")
ORACLES["src_07"] = q("select * from raw_zones")
ORACLES["src_08"] = q("""select strftime(m, '%Y-%m') as month, 'trips_' || strftime(m, '%Y-%m') || '.parquet' as file
from (select unnest(generate_series(date_trunc('month', min(tpep_pickup_datetime)),
                                    date_trunc('month', max(tpep_pickup_datetime)), interval 1 month)) as m
      from raw_trips)""")
ORACLES["src_09"] = q("select cast(c_custkey as integer) as c_custkey, c_name, "
                      "lpad(cast(c_nationkey as varchar), 3, '0') as nation_code, c_acctbal from customer")
for _k in ("snk_01", "snk_02", "snk_03", "snk_04", "snk_04_shallow", "inc_09", "dq_12"):
    ORACLES[_k] = q(FCT_ALL)

# -- windows, sorts, sets
ORACLES["win_01"] = ORACLES["flt_06"]
ORACLES["win_02"] = q("""
select s.day, coalesce(t.trips, 0) as trips
from (select cast(unnest(generate_series(min(pickup_date), max(pickup_date), interval 1 day)) as date) as day
      from fct_trips) s
left join (select pickup_date as day, count(*) as trips from fct_trips group by 1) t on s.day = t.day""")
ORACLES["srt_01"] = q("select pickup_borough, pickup_hour, trip_key from fct_trips")
ORACLES["srt_02"] = q("""
select 'trip_key' as column_name, cast(trip_key as varchar) as unique_field, count(*) as n_records
from fct_trips where trip_key is not null group by trip_key having count(*) > 1
union all
select 'pickup_zone_id', cast(pickup_zone_id as varchar), count(*)
from fct_trips where pickup_zone_id is not null group by pickup_zone_id having count(*) > 1""")
ORACLES["srt_03"] = q("select trip_key, total_amount, pickup_at from fct_trips "
                      "order by total_amount desc, trip_key, pickup_at limit 100")
ORACLES["set_01"] = q("select * from fct_target union all select * from fct_delta", DELTA_FCT)
ORACLES["set_02"] = q("select * from stg_renamed except select * from stg_trips")
ORACLES["set_03"] = q("""
select vendor_id, pickup_at, dropoff_at, pickup_zone_id, total_amount from stg_reload_all
intersect
select vendor_id, pickup_at, dropoff_at, pickup_zone_id, total_amount from stg_trips""",
                      RAW_AGAIN + "," + stg_from("stg_reload_all", "raw_reload"))

# -- incremental strategies
ORACLES["inc_01"] = q("select * from fct_target union all select * from fct_delta", DELTA_FCT)
ORACLES["inc_02"] = q("select * from fct_trips where _source_file not in (select distinct _source_file from fct_reload) "
                      "union all select * from fct_reload", RELOAD_FCT)
ORACLES["inc_02_materialized"] = ORACLES["inc_02"]
ORACLES["inc_02_watermark"] = q("select * from fct_target where _source_file not in "
                                "(select distinct _source_file from fct_delta) union all select * from fct_delta",
                                DELTA_FCT)
ORACLES["inc_02_composite"] = q("""
select * from lineitem t where not exists (
  select 1 from li_delta d where d.l_orderkey = t.l_orderkey and d.l_linenumber = t.l_linenumber
    and t.l_linestatus = 'F')
union all select * from li_delta""", """
li_delta as (select * replace (l_quantity + 1 as l_quantity) from lineitem where l_returnflag = 'R')""")
ORACLES["inc_03"] = q("select * from orders where o_orderkey not in (select o_orderkey from o_delta) "
                      "union all select * from o_delta", O_DELTA)
ORACLES["inc_06"] = ORACLES["inc_03"]
ORACLES["inc_03_update_columns"] = q("""
select t.o_orderkey, t.o_custkey, t.o_orderstatus,
  case when d.o_orderkey is not null then d.o_totalprice else t.o_totalprice end as o_totalprice,
  t.o_orderdate, t.o_orderpriority
from orders t left join o_delta d on t.o_orderkey = d.o_orderkey
union all select * from o_delta where o_orderkey not in (select o_orderkey from orders)""", O_DELTA)
ORACLES["inc_04"] = q("select * from fct_delta", DELTA_FCT)
ORACLES["inc_07"] = ORACLES["inc_04"]
ORACLES["inc_04_predicates"] = q("select * from fct_target where not coalesce(pickup_date >= date '2024-01-15', false) "
                                 "union all select * from fct_delta", DELTA_FCT)
ORACLES["inc_05"] = q(f"""
select * from fct_trips where not coalesce(pickup_at >= {RELOAD_FROM} and pickup_at < timestamp '2024-02-01', false)
union all
select * from fct_newer where pickup_at >= {RELOAD_FROM} and pickup_at < timestamp '2024-02-01'""",
                      RAW_AGAIN + "," + stg_from("stg_newer", "raw_reload", latest_only=True) + ","
                      + fct_from("fct_newer", "stg_newer"))
ORACLES["inc_05_concurrent"] = ORACLES["inc_05"]
ORACLES["inc_08_ignore"] = q(f"select * from fct_target union all select {_fct_cols({'airport_fee': 'cast(null as double)'})} "
                             f"from fct_delta", DELTA_FCT)
ORACLES["inc_08_append_new_columns"] = q(
    f"select *, cast(null as integer) as tip_bucket from fct_target union all "
    f"select {_fct_cols({'airport_fee': 'cast(null as double)'}, add=['cast(floor(tip_amount / 3) as integer) as tip_bucket'])} "
    f"from fct_delta", DELTA_FCT)
ORACLES["inc_08_sync_all_columns"] = q(
    f"select {_fct_cols({'passenger_count': 'cast(passenger_count as varchar)'}, drop=['airport_fee'], add=['cast(null as integer) as tip_bucket'])} "
    f"from fct_target union all "
    f"select {_fct_cols({'passenger_count': 'cast(passenger_count as varchar)'}, drop=['airport_fee'], add=['cast(floor(tip_amount / 3) as integer) as tip_bucket'])} "
    f"from fct_delta", DELTA_FCT)

# -- snapshots
CUST_V = f"""
v1 as (select *, {T1} as updated_at from customer where c_mktsegment <> 'BUILDING'),
v2 as (
  select c_custkey, c_name, c_nationkey,
    case when c_mktsegment = 'AUTOMOBILE' then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment,
    case when c_mktsegment = 'AUTOMOBILE' then {T2} else {T1} end as updated_at
  from customer where c_mktsegment <> 'MACHINERY'
)"""
SRC = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, updated_at"


def _h(x: str) -> str:
    return f"coalesce(cast({x} as varchar), '')"


def _scd_ts(deletes: str, keys=("c_custkey",), sentinel: str | None = None) -> str:
    vt = f"timestamp '{sentinel}'" if sentinel else "cast(null as timestamp)"
    kh = " || '|' || ".join(_h(f"{{t}}.{k}") for k in keys)
    on = " and ".join(f"h1.{k} = v2.{k}" for k in keys)
    v_src = ", ".join(f"v2.{c.strip()}" for c in SRC.split(","))
    h_src = ", ".join(f"h1.{c.strip()}" for c in SRC.split(","))
    h1 = (f"h1 as (select {SRC}, md5({kh.format(t='v1')} || '|' || {_h('v1.updated_at')}) as scd_id, "
          f"updated_at as scd_updated_at, updated_at as valid_from, {vt} as valid_to from v1)")
    gone = f"when v2.c_custkey is null then {T2} " if deletes == "invalidate" else ""
    body = f"""
select {h_src}, h1.scd_id, h1.scd_updated_at, h1.valid_from,
  case {gone}when h1.valid_from < v2.updated_at then v2.updated_at else h1.valid_to end as valid_to
from h1 left join v2 on {on}
union all
select {v_src}, md5({kh.format(t='v2')} || '|' || {_h('v2.updated_at')}), v2.updated_at, v2.updated_at, {vt}
from v2 left join h1 on {on}
where h1.c_custkey is null or h1.valid_from < v2.updated_at"""
    return q(body, CUST_V + ",\n" + h1)


ORACLES["scd_01"] = _scd_ts("invalidate")
ORACLES["scd_02"] = _scd_ts("ignore")
ORACLES["scd_06"] = _scd_ts("invalidate", keys=("c_custkey", "c_nationkey"), sentinel="9999-12-31 00:00:00")
ORACLES["scd_03"] = q(f"""
select h1.c_custkey, h1.c_name, h1.c_nationkey, h1.c_acctbal, h1.c_mktsegment, h1.scd_id, h1.scd_updated_at,
  h1.valid_from,
  case when v2.c_custkey is not null and (v2.c_acctbal is distinct from h1.c_acctbal or v2.c_name is distinct from h1.c_name)
       then {T2} else h1.valid_to end as valid_to
from h1 left join v2 on h1.c_custkey = v2.c_custkey
union all
select v2.c_custkey, v2.c_name, v2.c_nationkey, v2.c_acctbal, v2.c_mktsegment,
  md5({_h('v2.c_custkey')} || '|' || {_h(T2)}), {T2}, {T2}, cast(null as timestamp)
from v2 left join h1 on h1.c_custkey = v2.c_custkey
where h1.c_custkey is null or v2.c_acctbal is distinct from h1.c_acctbal or v2.c_name is distinct from h1.c_name""",
                      CUST_V + f""",
h1 as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  md5({_h('c_custkey')} || '|' || {_h(T1)}) as scd_id, {T1} as scd_updated_at, {T1} as valid_from,
  cast(null as timestamp) as valid_to from v1)""")
ORACLES["scd_04"] = q(f"""
select h1.c_custkey, h1.c_name, h1.c_nationkey, h1.c_acctbal, h1.c_mktsegment, h1.updated_at, h1.scd_id,
  h1.scd_updated_at, h1.valid_from,
  case when v2.c_custkey is null then {T2} when h1.valid_from < v2.updated_at then v2.updated_at
       else h1.valid_to end as valid_to, h1.is_deleted
from h1 left join v2 on h1.c_custkey = v2.c_custkey
union all
select v2.*, md5({_h('v2.c_custkey')} || '|' || {_h('v2.updated_at')}), v2.updated_at, v2.updated_at,
  cast(null as timestamp), 'False'
from v2 left join h1 on h1.c_custkey = v2.c_custkey
where h1.c_custkey is null or h1.valid_from < v2.updated_at
union all
select h1.c_custkey, h1.c_name, h1.c_nationkey, h1.c_acctbal, h1.c_mktsegment, h1.updated_at,
  md5({_h('h1.scd_id')} || '|' || {_h(T2)}), {T2}, {T2}, h1.valid_to, 'True'
from h1 left join v2 on h1.c_custkey = v2.c_custkey where v2.c_custkey is null""", CUST_V + f""",
h1 as (select *, md5({_h('c_custkey')} || '|' || {_h('updated_at')}) as scd_id, updated_at as scd_updated_at,
  updated_at as valid_from, cast(null as timestamp) as valid_to, 'False' as is_deleted from v1)""")
ORACLES["scd_05"] = q(f"select c_custkey, scd_id, valid_from from ({ORACLES['scd_01']})")

# -- quality tests
ORACLES["dq_01"] = q("select * from fct_trips where pickup_borough is null")
ORACLES["dq_01_declared"] = q(" union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as failures from fct_trips"
    for c in ("trip_key", "pickup_at", "total_amount")))
ORACLES["dq_02"] = q("select trip_key as unique_field, count(*) as n_records from fct_trips where trip_key is not null "
                     "group by trip_key having count(*) > 1")
ORACLES["dq_02_zone_id"] = q("select zone_id as unique_field, count(*) as n_records from dim_zones "
                             "where zone_id is not null group by zone_id having count(*) > 1")
_BOROUGHS = "'Manhattan','Brooklyn','Queens','Bronx','EWR','Staten Island','Unknown','N/A'"
ORACLES["dq_03"] = q(f"select * from (select borough as value_field, count(*) as n_records from dim_zones group by 1) "
                     f"where value_field not in ({_BOROUGHS})")
ORACLES["dq_03_fact"] = q("select * from (select pickup_borough as value_field, count(*) as n_records from fct_trips "
                          "group by 1) where value_field not in ('AFRICA', 'AMERICA', 'ASIA')")
_REL = ("select c.pickup_zone_id as from_field from fct_trips c left join dim_zones p on c.pickup_zone_id = p.zone_id "
        "where c.pickup_zone_id is not null and p.zone_id is null")
ORACLES["dq_04"] = q(_REL)
_ANN = " union all ".join(f"select '{c}' as column_name from fct_trips where {c} is null" for c in FCT_COLS
                         if c != "_loaded_at")
ORACLES["dq_05"] = q(_ANN)
ORACLES["dq_06"] = q(" union all ".join(
    f"select '{c}' as column_name, cast({c} as varchar) as unique_field, count(*) as n_records from fct_trips "
    f"where {c} is not null group by {c} having count(*) > 1"
    for c in ("trip_key", "pickup_zone_id", "payment_method", "pickup_date")))
ORACLES["dq_07"] = q("select count(*) as failures, count(*) != 0 as should_warn, count(*) != 0 as should_error "
                     "from (select * from fct_trips where pickup_borough is null)")
ORACLES["dq_07_custom"] = q("""
select cast(coalesce(sum(n_records), 0) as bigint) as failures, coalesce(sum(n_records), 0) > 10 as should_warn,
  coalesce(sum(n_records), 0) > 100000 as should_error
from (select trip_key, count(*) as n_records from fct_trips where trip_key is not null group by 1 having count(*) > 1)""")
ORACLES["dq_08"] = q("select column_name, count(*) as failures, count(*) > 0 as should_warn, count(*) > 0 as should_error "
                     "from (" + " union all ".join(f"select '{c}' as column_name from fct_trips where {c} is null"
                                                   for c in FCT_COLS) + ") group by 1")
ORACLES["dq_09"] = q(f"select count(*) as failures, count(*) != 0 as should_warn, count(*) != 0 as should_error "
                     f"from ({_REL})")
_DQC = "vendor_id, pickup_at, total_amount, _source_file, _loaded_at"
ORACLES["dq_10"] = q(f"""
select *, 'actual' as actual_or_expected from (select {_DQC} from stg_a except all select {_DQC} from stg_e)
union all
select *, 'expected' from (select {_DQC} from stg_e except all select {_DQC} from stg_a)""",
                     RAW_AGAIN + "," + stg_from("stg_a", "raw_reload") + ","
                     + stg_from("stg_e", "raw_reload", latest_only=True))
ORACLES["dq_13"] = q(f"select max(_loaded_at) as max_loaded_at, {T2} as snapshotted_at, "
                     f"date_diff('second', max(_loaded_at), {T2}) as age_seconds from raw_trips")
ORACLES["dq_13_filtered"] = ORACLES["dq_13"].replace("from raw_trips", "from raw_trips where VendorID = 2")
ORACLES["dq_14"] = q("select count(*) as row_count, cast(1 as bigint) as at_least, count(*) >= 1 as passed from fct_delta",
                     DELTA_FCT)

# -- scalar functions
ORACLES["fn_01"] = q("select trip_key, pickup_at, total_amount from fct_trips")
ORACLES["fn_02"] = q("select pickup_at, dropoff_at, trip_duration_seconds from stg_renamed")
ORACLES["fn_03_06"] = q("select pickup_at, pickup_date, pickup_hour, pickup_day_name, is_weekend from fct_trips")
ORACLES["fn_07_09"] = q("select trip_key, is_intra_borough, payment_method, rate_type, tip_pct_of_fare, avg_speed_mph "
                        "from fct_trips")
ORACLES["fn_10_13"] = q("select passenger_count, cast(round(passenger_count) as integer) as passenger_count_int, "
                        "round(total_amount / 3, 2) + 0.0 as third_total, "
                        "coalesce(passenger_count, cast(-1 as double)) as passenger_or_default from raw_trips")
ORACLES["fn_14_16"] = q("""select o_orderkey, cast(trunc(o_totalprice) as bigint) as price_bigint,
  try_cast(o_orderpriority as integer) as priority_int, try_cast(substring(o_orderpriority, 1, 1) as integer) as priority_digit,
  cast(o_orderstatus = 'F' as varchar) as is_final_text from orders""")
ORACLES["fn_17_23"] = q("""select c_custkey, c_name || '/' || c_mktsegment as name_segment, cast(length(c_name) as integer) as name_len,
  cast(position('#' in c_name) as integer) as hash_pos, replace(c_name, 'Customer', 'Cust') as short_name, right(c_name, 4) as name_tail,
  right(c_name, 0) as name_tail0, split_part(c_name, '#', 2) as name_part2, split_part(c_name, '#', -1) as name_part_last,
  md5(cast(c_custkey as varchar)) as key_hash from customer""")
ORACLES["fn_24_28"] = q("""select o_orderkey, date_trunc('month', o_orderdate) as order_month,
  o_orderdate + interval 1 month as plus_month, o_orderdate - interval 3 day as minus_3_days,
  date_diff('year', o_orderdate, timestamp '2000-01-01') as years_to_2000,
  date_diff('month', o_orderdate, timestamp '2000-01-01') as months_to_2000,
  date_diff('day', o_orderdate, timestamp '2000-01-01') as days_to_2000,
  date_diff('quarter', o_orderdate, timestamp '2000-01-01') as quarters_to_2000,
  date_diff('hour', o_orderdate, timestamp '2000-01-01 12:30:00') as hours_to_2000,
  cast(date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', timestamp '2000-01-01')) // 7 as bigint) as weeks_to_2000,
  date_diff('minute', o_orderdate, timestamp '2000-01-01 12:30:30') as minutes_to_2000,
  date_diff('second', o_orderdate, timestamp '2000-01-01 12:30:30') as seconds_to_2000,
  date_diff('microsecond', o_orderdate, timestamp '9999-12-30 00:00:00.000001') as micros_to_9999,
  date_trunc('week', o_orderdate) as order_week, cast(cast(o_orderdate as date) + interval 14 day as date) as due_date,
  last_day(o_orderdate) as month_end,
  cast(date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day as date) as quarter_end,
  cast(date_trunc('year', o_orderdate) + interval 12 month - interval 1 day as date) as year_end,
  make_date(year(o_orderdate), month(o_orderdate), 1) as month_start
from orders""")
ORACLES["fn_30_31"] = q("""select l_orderkey, l_linenumber, [l_quantity, l_discount] as qty_disc,
  list_append([l_quantity], l_tax) as qty_tax, list_concat([l_quantity], [l_extendedprice]) as qty_price,
  md5(coalesce(cast(l_orderkey as varchar), '') || '|' || coalesce(cast(l_linenumber as varchar), '') || '|'
      || coalesce(l_returnflag, '')) as scd_hash
from lineitem""")

# -- generators
ORACLES["gen_01"] = q("select unnest(generate_series(1, (select count(*) from orders))) as generated_number")
ORACLES["gen_02"] = q("""select cast(d as date) as date_day from (
  select unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date), interval 1 day)) as d,
    cast(max(o_orderdate) as date) as hi from orders) where cast(d as date) < hi""")
ORACLES["gen_02_month"] = q("""select cast(d as date) as date_month from (
  select unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date), interval 1 month)) as d,
    cast(max(o_orderdate) as date) as hi from orders) where cast(d as date) < hi""")
ORACLES["gen_03"] = q("""select strftime(d, '%Y%m%d') as partition from (
  select unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date), interval 1 day)) as d
  from orders)""")

# -- streaming and UDFs
ORACLES["str_01"] = q("select * from raw_trips")
ORACLES["str_02"] = ORACLES["agg_03"]
ORACLES["udf_01"] = q("select pickup_at, tip_amount, fare_amount, round(tip_amount / nullif(fare_amount, 0) * 100, 2) "
                      "as tip_pct from stg_trips")
ORACLES["udf_02"] = q("select pickup_date, count(*) as trips, round(sum(total_amount), 2) as revenue from fct_trips "
                      "group by 1")


# -- inventory rows composed from the operators above
ORACLES["flt_09"] = q("select * from fct_trips where payment_method = 'Cash' and pickup_borough is null")
_CUR_V1 = CUST_V + ",\ncur as (select c_custkey, c_acctbal, updated_at as valid_from from v1)"
ORACLES["jon_04"] = q("""select v2.c_custkey, cur.c_acctbal as old_acctbal, v2.c_acctbal as new_acctbal, v2.updated_at
from v2 join cur on v2.c_custkey = cur.c_custkey where cur.valid_from < v2.updated_at""", _CUR_V1)
ORACLES["jon_05"] = q("""select c_custkey, 'insert' as change from v2 where c_custkey not in (select c_custkey from cur)
union all select c_custkey, 'delete' from cur where c_custkey not in (select c_custkey from v2)""", _CUR_V1)
ORACLES["jon_06"] = ORACLES["gen_01"]
ORACLES["agg_06"] = q("""select case when grouping(pickup_borough) = 0 then 'pickup_borough' else 'payment_method' end
  as grouped_by, coalesce(pickup_borough, payment_method) as value, count(*) as trips
from fct_trips group by grouping sets ((pickup_borough), (payment_method))""")
ORACLES["fn_29"] = q("""select count(case when _loaded_at < cast(current_timestamp as timestamp) then 1 end) as loaded_before_now,
  count(case when tpep_pickup_datetime < cast(current_timestamp as timestamp) then 1 end) as picked_up_before_now
from raw_trips""")
ORACLES["dq_suite"] = q(f"""
select 'unique_dim_zones_zone_id' as test_name, count(*) as failures, count(*) != 0 as should_warn, count(*) != 0 as should_error
from (select zone_id from dim_zones where zone_id is not null group by zone_id having count(*) > 1)
union all select 'not_null_dim_zones_zone_id', count(*), count(*) != 0, count(*) != 0 from dim_zones where zone_id is null
union all select 'accepted_values_dim_zones_borough', count(*), count(*) != 0, count(*) != 0
from (select borough from dim_zones group by borough) where borough not in ({_BOROUGHS})
union all select 'not_null_fct_trips_trip_key', count(*), count(*) != 0, count(*) != 0 from fct_trips where trip_key is null
union all select 'not_null_fct_trips_pickup_at', count(*), count(*) != 0, count(*) != 0 from fct_trips where pickup_at is null
union all select 'not_null_fct_trips_total_amount', count(*), count(*) != 0, count(*) != 0 from fct_trips where total_amount is null
union all select 'relationships_fct_trips_pickup_zone_id', count(*), count(*) != 0, count(*) != 0 from ({_REL})""")
ORACLES["flt_05_per_file"] = q("""
select s.* from stg_trips s
left join (select _source_file, max(_loaded_at) as wm from fct_target
           where _source_file <> 'trips_2024-01-10.parquet' group by 1) w on s._source_file = w._source_file
where w.wm is null or s._loaded_at > w.wm""", FCT_TARGET)
ORACLES["agg_09_limit"] = q("""
select pickup_date, string_agg(trip_key, '|' order by rn) as top_trip_keys from (
  select pickup_date, trip_key,
    row_number() over (partition by pickup_date order by total_amount desc, trip_key) as rn
  from fct_trips) where rn <= 3 group by 1""")
ORACLES["scd_06_column_names"] = q("select * rename (scd_id as version_key, scd_updated_at as snapshot_at, "
                                   "valid_from as effective_from, valid_to as effective_to) from ("
                                   + ORACLES["scd_01"] + ")")
ORACLES["dq_13_custom"] = q(f"select max(_loaded_at) as max_loaded_at, {T2} as snapshotted_at from raw_trips "
                            f"where VendorID <> 1")
ORACLES["scd_01_split"] = ORACLES["scd_01"]
ORACLES["src_01_load"] = q("select * exclude (_loaded_at) from raw_trips")


# -- fixtures on which a broken operator fails
_LINES = "(select l_orderkey || '-' || l_linenumber as trip_key from lineitem)"
_TWICE = f"(select trip_key, count(*) as n_records from {_LINES} group by 1 having count(*) > 1)"
ORACLES["dq_02_duplicates"] = f"select trip_key as unique_field, n_records from {_TWICE}"
ORACLES["dq_07_custom_duplicates"] = (
    "select cast(coalesce(sum(n_records), 0) as bigint) as failures, coalesce(sum(n_records), 0) > 10 as should_warn, "
    f"coalesce(sum(n_records), 0) > 100000000 as should_error from {_TWICE}")
ORACLES["agg_11_duplicates"] = f"""
select cast(sum(n) as bigint) as total_rows, cast(0 as bigint) as null_keys, count(*) as distinct_keys,
  count(case when n > 1 then 1 end) as colliding_keys,
  cast(coalesce(sum(case when n > 1 then n end), 0) as bigint) as rows_in_collisions,
  round((sum(n) - count(*)) * 100.0 / sum(n), 4) as collision_pct
from (select trip_key, count(*) as n from {_LINES} group by 1)"""
ORACLES["scd_03_updated_at"] = q(f"""
select h1.c_custkey, h1.c_name, h1.c_nationkey, h1.c_acctbal, h1.c_mktsegment, h1.updated_at, h1.scd_id, h1.scd_updated_at,
  h1.valid_from, case when v2.c_acctbal is distinct from h1.c_acctbal and v2.c_custkey is not null then v2.updated_at
                 else h1.valid_to end as valid_to
from h1 left join v2 on h1.c_custkey = v2.c_custkey
union all
select v2.c_custkey, v2.c_name, v2.c_nationkey, v2.c_acctbal, v2.c_mktsegment, v2.updated_at,
  md5({_h('v2.c_custkey')} || '|' || {_h('v2.updated_at')}), v2.updated_at, v2.updated_at, cast(null as timestamp)
from v2 left join h1 on h1.c_custkey = v2.c_custkey
where h1.c_custkey is null or v2.c_acctbal is distinct from h1.c_acctbal""",
                                 CUST_V + f""",
h1 as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, updated_at,
  md5({_h('c_custkey')} || '|' || {_h(T1)}) as scd_id, {T1} as scd_updated_at, {T1} as valid_from,
  cast(null as timestamp) as valid_to from v1)""")
ORACLES["scd_03_all"] = ORACLES["scd_03"]  # only the balance ever changes here
ORACLES["src_08_load"] = q("""
select 'trips_' || strftime(tpep_pickup_datetime, '%Y-%m') || '.parquet' as file, count(*) as n_rows,
  cast(sum("VendorID") as bigint) as vendor_sum, max(tpep_pickup_datetime) as last_pickup from raw_trips group by 1""")
ORACLES["inc_03_exclude_columns"] = q("""
select t.o_orderkey, t.o_custkey, t.o_orderstatus,
  case when d.o_orderkey is not null then d.o_totalprice else t.o_totalprice end as o_totalprice,
  t.o_orderdate, t.o_orderpriority
from orders t left join o_delta d on t.o_orderkey = d.o_orderkey
union all select * from o_delta where o_orderkey not in (select o_orderkey from orders)""", O_DELTA)
ORACLES["inc_06_default"] = ORACLES["inc_03"]
ORACLES["inc_08_append_new_columns_stored"] = ORACLES["inc_08_append_new_columns"]
ORACLES["inc_08_sync_all_columns_stored"] = ORACLES["inc_08_sync_all_columns"]
ORACLES["str_02_incremental"] = ORACLES["inc_01"]
ORACLES["str_02_stream"] = """select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority from orders"""
ORACLES["src_01_drift"] = q("select * exclude (_loaded_at) from raw_trips")
_CHANGED = ("select * exclude (_loaded_at, _source_file), 'trips first.parquet' as _source_file from raw_trips "
            "where tpep_pickup_datetime < timestamp '2024-01-16' union all "
            "select * exclude (_loaded_at, _source_file) replace (total_amount + 1 as total_amount), 'trips 100%.parquet' as _source_file "
            "from raw_trips where tpep_pickup_datetime >= timestamp '2024-01-16' and payment_type <> 0")
ORACLES["src_05_changed"] = q(_CHANGED)
ORACLES["str_01_changed"] = q(_CHANGED)
ORACLES["str_02_aggregate"] = ORACLES["agg_03"]
ORACLES["inc_03_buckets"] = ORACLES["inc_03"]
ORACLES["inc_02_buckets"] = ORACLES["inc_02_composite"]
ORACLES["str_02_stream_buckets"] = ORACLES["str_02_stream"]
