"""Adapters that give the driver's synthetic tables the shapes of the pipeline's inputs.

The test tables hold no trip records, so ``events`` is re-read in the layout of
a monthly trip file (one landing file per event day) and ``nation`` x ``region``
plays the zone lookup.  Every column is a deterministic expression of the
source row, so the same rows can be stated in plain SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import ingest_trips


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the column layout of a monthly trip file, with lineage columns."""
    ev = table(spark, sf_dir, "events")
    eid, uid, ts, val = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("value")
    dbl = lambda c: c.cast("double")
    return ev.select(
        (uid % 3 + 1).cast("bigint").alias("VendorID"),
        ts.alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", ((eid * 37) % 5400 - 60).cast("int"), ts).alias("tpep_dropoff_datetime"),
        F.when(eid % 41 == 0, F.lit(None).cast("double")).otherwise(dbl(eid % 6)).alias("passenger_count"),
        F.when(eid % 53 == 0, F.lit(0.0)).otherwise(dbl(eid % 300) / 10).alias("trip_distance"),
        dbl(eid % 8).alias("RatecodeID"),
        F.when(eid % 2 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("store_and_fwd_flag"),
        (uid % 27).alias("PULocationID"),
        (eid % 27).alias("DOLocationID"),
        (eid % 8).alias("payment_type"),
        F.when(eid % 97 == 0, F.lit(0.0)).otherwise(val).alias("fare_amount"),
        (dbl(eid % 4) / 2).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        dbl(eid % 9).alias("tip_amount"),
        dbl(eid % 7).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (val - 5).alias("total_amount"),
        F.when(uid % 2 == 0, F.lit(2.5)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        F.when(eid % 13 == 0, F.lit(None).cast("double")).otherwise(dbl(eid % 3) * 1.25).alias("Airport_fee"),
        F.concat(F.lit("trips_"), F.date_format(ts, "yyyy-MM-dd"), F.lit(".parquet")).alias("_source_file"),
        F.timestamp_add("DAY", F.lit(1), F.date_trunc("DAY", ts)).alias("_loaded_at"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived landing rows pushed through the real ingest projection."""
    return ingest_trips(landing_trips(spark, sf_dir))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup rows: nation ids are zone ids, region names are boroughs."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        nation.n_nationkey.cast("bigint").alias("locationid"),
        region.r_name.alias("borough"),
        nation.n_name.alias("zone"),
        F.when(nation.n_nationkey % 5 == 0, F.lit("Airports")).otherwise(F.lit("Boro Zone")).alias("service_zone"),
    )
