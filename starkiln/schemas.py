"""Schemas of the raw, staging and mart relations."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip table: fixed DDL, 19 file columns + 2 lineage columns.
RAW_TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_loaded_at", T.TimestampType()),
    ]
)

RAW_FILE_COLUMNS = [f.name for f in RAW_TRIPS.fields if not f.name.startswith("_")]

RAW_ZONES = T.StructType(
    [
        T.StructField("locationid", T.LongType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

STG_TRIPS_COLUMNS = [
    "vendor_id", "pickup_at", "dropoff_at", "passenger_count", "trip_distance_miles", "rate_code_id",
    "store_and_fwd_flag", "pickup_zone_id", "dropoff_zone_id", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
    "total_amount", "trip_duration_seconds", "_source_file", "_loaded_at",
]

DIM_ZONES_COLUMNS = ["zone_id", "borough", "zone_name", "service_zone", "is_manhattan"]

# Fact table: 30 columns, in this order.
FCT_TRIPS_COLUMNS = [
    "trip_key", "pickup_at", "dropoff_at", "pickup_date", "pickup_hour", "pickup_day_name", "is_weekend",
    "pickup_zone_id", "pickup_borough", "pickup_zone", "dropoff_zone_id", "dropoff_borough", "dropoff_zone",
    "is_intra_borough", "passenger_count", "trip_distance_miles", "trip_duration_seconds",
    "trip_duration_minutes", "avg_speed_mph", "fare_amount", "tip_amount", "tolls_amount",
    "congestion_surcharge", "airport_fee", "total_amount", "tip_pct_of_fare", "payment_method", "rate_type",
    "_source_file", "_loaded_at",
]

# Boroughs accepted by the dimension's declared test.
ACCEPTED_BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "EWR", "Staten Island", "Unknown", "N/A"]

# The declared types of the trip fact, in its column order.
FCT_TRIPS_CONTRACT = [
    ("trip_key", "string"),
    ("pickup_at", "timestamp_ntz"),
    ("dropoff_at", "timestamp_ntz"),
    ("pickup_date", "date"),
    ("pickup_hour", "int"),
    ("pickup_day_name", "string"),
    ("is_weekend", "boolean"),
    ("pickup_zone_id", "bigint"),
    ("pickup_borough", "string"),
    ("pickup_zone", "string"),
    ("dropoff_zone_id", "bigint"),
    ("dropoff_borough", "string"),
    ("dropoff_zone", "string"),
    ("is_intra_borough", "boolean"),
    ("passenger_count", "int"),
    ("trip_distance_miles", "double"),
    ("trip_duration_seconds", "bigint"),
    ("trip_duration_minutes", "double"),
    ("avg_speed_mph", "double"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
    ("total_amount", "double"),
    ("tip_pct_of_fare", "double"),
    ("payment_method", "string"),
    ("rate_type", "string"),
    ("_source_file", "string"),
    ("_loaded_at", "timestamp"),
]
