"""Analytic queries over the trip fact.

All are hash aggregates with map-side partial aggregation, so a borough or
rate type holding a third of the trips is reduced to one row per task before
the shuffle; none needs a sort of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tipping_by_borough(fct: DataFrame, min_trips: int = 1000,
                       methods: tuple[str, ...] = ("Credit card", "Cash")) -> DataFrame:
    """Trips, average tip % and average total by pickup borough x payment method."""
    return (fct.filter(F.col("payment_method").isin(*methods))
            .groupBy("pickup_borough", "payment_method")
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.avg("tip_pct_of_fare"), 1).alias("avg_tip_pct"),
                 F.round(F.avg("total_amount"), 2).alias("avg_fare"))
            .filter(F.col("trips") > min_trips)
            .orderBy("pickup_borough", "payment_method"))


def congestion_by_hour(fct: DataFrame, lo: float = 1, hi: float = 60) -> DataFrame:
    """Average speed and trips by pickup borough x hour, weekdays, speeds within [lo, hi]."""
    return (fct.filter((F.col("is_weekend") == F.lit(False)) & F.col("avg_speed_mph").between(lo, hi))
            .groupBy("pickup_borough", "pickup_hour")
            .agg(F.round(F.avg("avg_speed_mph"), 1).alias("mph"), F.count(F.lit(1)).alias("trips"))
            .orderBy("pickup_borough", "pickup_hour"))


def airport_economics(fct: DataFrame, rates: tuple[str, ...] = ("Standard", "JFK", "Newark")) -> DataFrame:
    """Trips, average miles/minutes/total by rate type, busiest first."""
    return (fct.filter(F.col("rate_type").isin(*rates))
            .groupBy("rate_type")
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.avg("trip_distance_miles"), 2).alias("avg_miles"),
                 F.round(F.avg("trip_duration_minutes"), 1).alias("avg_minutes"),
                 F.round(F.avg("total_amount"), 2).alias("avg_total"))
            .orderBy(F.col("trips").desc()))


def key_collision_rate(fct: DataFrame, key: str = "trip_key") -> DataFrame:
    """Rows vs distinct keys: how many rows share a surrogate key with another row.

    Exact: a partial count per key (map-side combine) then a global sum; no
    ``countDistinct`` over the whole table in one task.
    """
    per_key = fct.groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # NULL keys form one group
    keyed = F.col(key).isNotNull()
    hit = keyed & (F.col("n") > 1)
    one = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(~keyed, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count(F.when(keyed, 1)).alias("distinct_keys"),
        F.count(F.when(hit, 1)).alias("colliding_keys"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("bigint").alias("rows_in_collisions"),
    )
    keyed_rows = F.col("total_rows") - F.col("null_keys")
    return one.select("total_rows", "null_keys", "distinct_keys", "colliding_keys", "rows_in_collisions",
                      F.round(F.try_divide((keyed_rows - F.col("distinct_keys")) * 100.0, keyed_rows)
                              .cast("double"), 4).alias("collision_pct"))
