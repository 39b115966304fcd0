"""DuckDB SQL for the shared derived relations (trips, zones, staging, marts).

These restate, in plain SQL, exactly what the Spark adapters and models
compute, so each registered query can be checked against an independent engine.
"""

RAW_TRIPS = """
raw_trips as (
  select cast(user_id % 3 + 1 as bigint) as VendorID,
    ts as tpep_pickup_datetime,
    ts + to_seconds((event_id * 37) % 5400 - 60) as tpep_dropoff_datetime,
    case when event_id % 41 = 0 then null else cast(event_id % 6 as double) end as passenger_count,
    case when event_id % 53 = 0 then cast(0 as double) else cast(event_id % 300 as double) / 10 end as trip_distance,
    cast(event_id % 8 as double) as RatecodeID,
    case when event_id % 2 = 0 then 'N' else 'Y' end as store_and_fwd_flag,
    user_id % 27 as PULocationID,
    event_id % 27 as DOLocationID,
    event_id % 8 as payment_type,
    case when event_id % 97 = 0 then cast(0 as double) else value end as fare_amount,
    cast(event_id % 4 as double) / 2 as extra,
    cast(0.5 as double) as mta_tax,
    cast(event_id % 9 as double) as tip_amount,
    cast(event_id % 7 as double) as tolls_amount,
    cast(1 as double) as improvement_surcharge,
    value - 5 as total_amount,
    case when user_id % 2 = 0 then cast(2.5 as double) else cast(0 as double) end as congestion_surcharge,
    case when event_id % 13 = 0 then null else cast(event_id % 3 as double) * cast(1.25 as double) end as Airport_fee,
    concat('trips_', strftime(ts, '%Y-%m-%d'), '.parquet') as _source_file,
    date_trunc('day', ts) + interval 1 day as _loaded_at
  from events
)"""

# Staging column <- raw column (None: the same name).
STAGED = {
    "vendor_id": "VendorID", "pickup_at": "tpep_pickup_datetime", "dropoff_at": "tpep_dropoff_datetime",
    "trip_distance_miles": "trip_distance", "pickup_zone_id": "PULocationID", "dropoff_zone_id": "DOLocationID",
    "airport_fee": "Airport_fee", "store_and_fwd_flag": None, "payment_type": None, "fare_amount": None, "extra": None,
    "mta_tax": None, "tip_amount": None, "tolls_amount": None, "improvement_surcharge": None,
    "congestion_surcharge": None, "total_amount": None, "_source_file": None, "_loaded_at": None,
}
# Codes that arrive as floating point and are rounded to integers.
ROUNDED = {"passenger_count": "passenger_count", "rate_code_id": "RatecodeID"}

STG_SELECT = "select " + ", ".join(
    [f"{raw or name} as {name}" for name, raw in STAGED.items()]
    + [f"cast(round({raw}) as integer) as {name}" for name, raw in ROUNDED.items()]
    + ["date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) as trip_duration_seconds"])

STG_WHERE = """pickup_at >= timestamp '2024-01-01' and pickup_at < timestamp '2025-01-01'
    and dropoff_at > pickup_at and trip_distance_miles > 0 and total_amount > 0"""


def stg_from(name: str, src: str, latest_only: bool = False) -> str:
    """CTE ``name``: staging (rename, retype, filter) of the raw-shaped relation ``src``."""
    body = f"select * from ({STG_SELECT} from {src}) where {STG_WHERE}"
    if latest_only:
        body = (f"select * exclude (__mx) from (select *, max(_loaded_at) over (partition by _source_file) as __mx "
                f"from ({body})) where _loaded_at = __mx")
    return f"\n{name} as ({body})"


STG_TRIPS_ALL = f"""
stg_renamed as ({STG_SELECT} from raw_trips)"""

STG_TRIPS = """
stg_trips as (select * from stg_renamed where """ + STG_WHERE + """)"""

ZONES = """
raw_zones as (
  select cast(n_nationkey as bigint) as locationid, r_name as borough, n_name as zone,
    case when n_nationkey % 5 = 0 then 'Airports' else 'Boro Zone' end as service_zone
  from nation left join region on n_regionkey = r_regionkey
),
stg_zones as (
  select locationid as zone_id, borough, zone as zone_name, service_zone from raw_zones where locationid is not null
),
dim_zones as (
  select zone_id, borough, zone_name, service_zone, coalesce(borough = 'Manhattan', false) as is_manhattan
  from stg_zones
)"""

TS_FMT = "'%Y-%m-%d %H:%M:%S.%g'"


def trip_key_sql(t: str = "t") -> str:
    return (f"md5(cast({t}.vendor_id as varchar) || '|' || strftime({t}.pickup_at, {TS_FMT}) || '|' || "
            f"strftime({t}.dropoff_at, {TS_FMT}) || '|' || cast({t}.pickup_zone_id as varchar) || '|' || "
            f"cast(try_cast({t}.total_amount as decimal(38,2)) as varchar))")


# Labels of the payment and rate codes; any other code has the label under None.
PAYMENTS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip", None: "Unmapped"}
RATES = {1: "Standard", 2: "JFK", 3: "Newark", 4: "Nassau/Westchester", 5: "Negotiated", 6: "Group ride", None: "Unknown"}


def _lookup(labels: dict, alias: str) -> str:
    rows = ", ".join(f"({code}, '{label}')" for code, label in labels.items() if code is not None)
    return f"(values {rows}) as {alias}(code, label)"


def _ratio(top: str, bottom: str, scale: int = 1) -> str:
    """scale * top / bottom to two places, NULL where the bottom is zero."""
    return f"round({top} / nullif({bottom}, 0) * cast({scale} as double), 2)"


def fct_select(src: str) -> str:
    """The fact over a staging relation: each zone lookup and each label is a left join."""
    hours = "(s.trip_duration_seconds / cast(3600 as double))"
    measures = {
        "trip_duration_minutes": "round(s.trip_duration_seconds / cast(60 as double), 2)",
        "avg_speed_mph": _ratio("s.trip_distance_miles", hours),
        "tip_pct_of_fare": _ratio("s.tip_amount", "s.fare_amount", 100),
    }
    calendar = {
        "pickup_date": "cast(s.pickup_at as date)", "pickup_hour": "cast(hour(s.pickup_at) as integer)",
        "pickup_day_name": "strftime(s.pickup_at, '%a')", "is_weekend": "coalesce(isodow(s.pickup_at) >= 6, false)",
    }
    zones = {f"{end}_{out}": f"{end}_zone.{col}" for end in ("pickup", "dropoff")
             for out, col in (("borough", "borough"), ("zone", "zone_name"))}
    labels = {"payment_method": f"coalesce(pay.label, '{PAYMENTS[None]}')", "rate_type": f"coalesce(rate.label, '{RATES[None]}')"}
    derived = {"trip_key": trip_key_sql("s"), **calendar, **zones,
               "is_intra_borough": "coalesce(pickup_zone.borough = dropoff_zone.borough, false)", **measures, **labels}
    kept = ["pickup_at", "dropoff_at", "pickup_zone_id", "dropoff_zone_id", "passenger_count", "trip_distance_miles",
            "trip_duration_seconds", "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee",
            "total_amount", "_source_file", "_loaded_at"]
    columns = {**{c: f"s.{c}" for c in kept}, **derived}
    joins = [f"left join dim_zones as {end}_zone on {end}_zone.zone_id = s.{end}_zone_id" for end in ("pickup", "dropoff")]
    joins += [f"left join {_lookup(PAYMENTS, 'pay')} on pay.code = s.payment_type",
              f"left join {_lookup(RATES, 'rate')} on rate.code = s.rate_code_id"]
    return "\n  select " + ", ".join(f"{columns[c]} as {c}" for c in FCT_ORDER) + f"\n  from {src} as s " + " ".join(joins)


# The fact's columns in order.
FCT_ORDER = [
    "trip_key", "pickup_at", "dropoff_at", "pickup_date", "pickup_hour", "pickup_day_name", "is_weekend", "pickup_zone_id",
    "pickup_borough", "pickup_zone", "dropoff_zone_id", "dropoff_borough", "dropoff_zone", "is_intra_borough",
    "passenger_count", "trip_distance_miles", "trip_duration_seconds", "trip_duration_minutes", "avg_speed_mph", "fare_amount",
    "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee", "total_amount", "tip_pct_of_fare", "payment_method",
    "rate_type", "_source_file", "_loaded_at",
]


def fct_from(name: str, src: str) -> str:
    return f"\n{name} as ({fct_select(src)}\n)"


FCT_TRIPS = fct_from("fct_trips", "stg_trips")

ALL_CTES = ",".join([RAW_TRIPS, STG_TRIPS_ALL, STG_TRIPS, ZONES, FCT_TRIPS])


def q(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the shared CTEs (plus optional extra CTEs)."""
    extra = ("," + extra_ctes) if extra_ctes.strip() else ""
    return f"with {ALL_CTES}{extra}\n{body}"
