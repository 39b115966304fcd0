"""Staging and mart models as lazy DataFrame plans.

``stg_trips`` -> ``fct_trips`` is one narrow pipeline (projection + filters +
two dimension lookups); the only data movement is the broadcast of the small zone dimension.  Filters on the renamed columns are pushed by
Catalyst through the aliases down to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import dayname, is_weekend, seconds_between
from ..functions.scalar import float_to_int, iff, payment_method, rate_type, safe_divide, surrogate_key
from ..operators.filters import latest_batch
from ..schemas import FCT_TRIPS_COLUMNS

# Staging keeps pickups of calendar 2024 (half-open window).
DEFAULT_WINDOW = ("2024-01-01", "2025-01-01")


def stg_trips_renamed(raw: DataFrame) -> DataFrame:
    """Rename and retype the raw trip columns; add the trip duration in seconds."""
    return raw.select(
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_at"),
        F.col("tpep_dropoff_datetime").alias("dropoff_at"),
        float_to_int("passenger_count").alias("passenger_count"),
        F.col("trip_distance").alias("trip_distance_miles"),
        float_to_int("RatecodeID").alias("rate_code_id"),
        "store_and_fwd_flag",
        F.col("PULocationID").alias("pickup_zone_id"),
        F.col("DOLocationID").alias("dropoff_zone_id"),
        "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge",
        F.col("Airport_fee").alias("airport_fee"),
        "total_amount",
        seconds_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_seconds"),
        "_source_file", "_loaded_at",
    )


def trip_rules(window: tuple[str, str] = DEFAULT_WINDOW) -> dict:
    """The staging row filters, by name (used by ``stg_trips`` and the filter audit)."""
    lo, hi = window
    return {
        "pickup_in_window": (F.col("pickup_at") >= F.lit(lo).cast("timestamp_ntz"))
        & (F.col("pickup_at") < F.lit(hi).cast("timestamp_ntz")),
        "dropoff_after_pickup": F.col("dropoff_at") > F.col("pickup_at"),
        "positive_distance": F.col("trip_distance_miles") > 0,
        "positive_total": F.col("total_amount") > 0,
    }


def stg_trips(raw: DataFrame, window: tuple[str, str] = DEFAULT_WINDOW, latest_only: bool = False) -> DataFrame:
    """Typed, filtered trips.  ``latest_only`` adds the latest-batch-per-file rule."""
    df = stg_trips_renamed(raw)
    cond = None
    for pred in trip_rules(window).values():
        cond = pred if cond is None else cond & pred
    df = df.filter(cond)
    return latest_batch(df) if latest_only else df


def stg_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.select(
        F.col("locationid").alias("zone_id"), "borough", F.col("zone").alias("zone_name"), "service_zone",
    ).filter(F.col("zone_id").isNotNull())


def dim_zones(stg: DataFrame) -> DataFrame:
    return stg.select("zone_id", "borough", "zone_name", "service_zone",
                      F.coalesce(F.col("borough") == F.lit("Manhattan"), F.lit(False)).alias("is_manhattan"))


def trip_key() -> F.Column:
    return surrogate_key("vendor_id", ("pickup_at", "timestamp"), ("dropoff_at", "timestamp"),
                         "pickup_zone_id", ("total_amount", "amount"))


def fct_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The 30-column trip fact: trips left-joined to the zone dimension twice.

    Spark broadcasts the dimension while its size is below the threshold; otherwise both
    lookups are shuffle joins (adaptive execution splits skewed zones).  Unknown zones keep
    the fact row (LEFT joins).
    """
    z = zones.select("zone_id", "borough", "zone_name")
    pu = z.select(F.col("zone_id").alias("__pu_id"), F.col("borough").alias("pickup_borough"),
                  F.col("zone_name").alias("pickup_zone"))
    do = z.select(F.col("zone_id").alias("__do_id"), F.col("borough").alias("dropoff_borough"),
                  F.col("zone_name").alias("dropoff_zone"))
    t = trips.join(pu, trips["pickup_zone_id"] == pu["__pu_id"], "left")
    t = t.join(do, t["dropoff_zone_id"] == do["__do_id"], "left")
    dur = F.col("trip_duration_seconds")
    out = t.select(
        trip_key().alias("trip_key"),
        "pickup_at", "dropoff_at",
        F.to_date("pickup_at").alias("pickup_date"),
        F.hour("pickup_at").alias("pickup_hour"),
        dayname("pickup_at").alias("pickup_day_name"),
        is_weekend("pickup_at").alias("is_weekend"),
        "pickup_zone_id", "pickup_borough", "pickup_zone",
        "dropoff_zone_id", "dropoff_borough", "dropoff_zone",
        iff(F.col("pickup_borough") == F.col("dropoff_borough"), True, False).alias("is_intra_borough"),
        "passenger_count", "trip_distance_miles", "trip_duration_seconds",
        F.round(dur / F.lit(60.0), 2).alias("trip_duration_minutes"),
        F.round(safe_divide("trip_distance_miles", dur / F.lit(3600.0)), 2).alias("avg_speed_mph"),
        "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee", "total_amount",
        F.round(safe_divide("tip_amount", "fare_amount") * F.lit(100.0), 2).alias("tip_pct_of_fare"),
        payment_method("payment_type").alias("payment_method"),
        rate_type("rate_code_id").alias("rate_type"),
        "_source_file", "_loaded_at",
    )
    return out.select(*FCT_TRIPS_COLUMNS)
