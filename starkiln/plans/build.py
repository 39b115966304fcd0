"""Build the marts: models and tests together, in dependency order.

``build_marts`` materializes the zone dimension as a table and tests it, then builds the
trip fact incrementally (watermark on ``_loaded_at`` + delete+insert keyed on the
partition column ``_source_file``) and tests that.
It returns one result record per node, like a run log.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters as FL
from ..operators import incremental as INC
from ..operators import quality as Q
from ..operators import sinks
from ..schemas import ACCEPTED_BOROUGHS
from . import models as M


def dimension_tests(dim: DataFrame) -> DataFrame:
    """Verdicts of the dimension's declared tests."""
    return Q.run_tests([
        ("unique_dim_zones_zone_id", Q.unique(dim, "zone_id")),
        ("not_null_dim_zones_zone_id", Q.not_null(dim, "zone_id")),
        ("accepted_values_dim_zones_borough", Q.accepted_values(dim, "borough", ACCEPTED_BOROUGHS)),
    ])


def fact_tests(fct: DataFrame, dim: DataFrame) -> DataFrame:
    """Verdicts of the fact's declared tests: the not-null tests share one scan."""
    nulls = Q.run_declared_tests(fct, ["trip_key", "pickup_at", "total_amount"]).select(
        F.concat(F.lit("not_null_fct_trips_"), "column_name").alias("test_name"), "failures",
        (F.col("failures") != 0).alias("should_warn"), (F.col("failures") != 0).alias("should_error"))
    return nulls.unionByName(Q.run_tests([
        ("relationships_fct_trips_pickup_zone_id", Q.relationships(fct, "pickup_zone_id", dim, "zone_id"))]))


def build_marts(spark: SparkSession, raw_trips: DataFrame, raw_zones: DataFrame, fact: str = "fct_trips",
                dim: str = "dim_zones", root: str | None = None, window=M.DEFAULT_WINDOW, latest_only: bool = True,
                full_refresh: bool = False, run_tests: bool = True) -> list[dict]:
    """``latest_only`` (the default) keeps only the latest batch of each source file.  A dimension
    test that fails stops the build before the fact, which then is reported as skipped."""
    results: list[dict] = []

    def test(verdicts: DataFrame) -> bool:
        """Append the verdicts; True if none is an error."""
        t0 = time.perf_counter()
        rows = verdicts.collect()  # one row per declared test
        secs = round(time.perf_counter() - t0, 3)
        for v in rows:
            status = "fail" if v["should_error"] else ("warn" if v["should_warn"] else "pass")
            results.append({"node": v["test_name"], "kind": "test", "status": status, "failures": v["failures"], "secs": secs})
        return not any(v["should_error"] for v in rows)

    t0 = time.perf_counter()
    d = sinks.as_table(M.dim_zones(M.stg_zones(raw_zones)), dim, root=root)
    results.append({"node": dim, "kind": "model", "status": "success", "rows_affected": d.count(),
                    "secs": round(time.perf_counter() - t0, 3)})

    if run_tests and not test(dimension_tests(spark.table(dim))):
        results.append({"node": fact, "kind": "model", "status": "skipped", "rows_affected": 0, "secs": 0.0})
        return results

    def model(s: SparkSession, is_inc: bool) -> DataFrame:
        stg = M.stg_trips(raw_trips, window, latest_only)
        if is_inc:
            stg = FL.since_watermark(stg, s.table(fact))
        return M.fct_trips(stg, s.table(dim))

    t0 = time.perf_counter()
    r = INC.incremental(spark, fact, model, "delete+insert", "_source_file", full_refresh=full_refresh,
                        partition_by=["_source_file"], root=root)
    results.append({"node": fact, "kind": "model", "status": "success", "rows_affected": r["rows_inserted"],
                    "mode": r["mode"], "secs": round(time.perf_counter() - t0, 3)})

    if run_tests:
        test(fact_tests(spark.table(fact), spark.table(dim)))
    return results
