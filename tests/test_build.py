import uuid

from pyspark.sql import functions as F

from starkiln.plans.build import build_marts
from starkiln.session import scratch_path
from starkiln.sources import driver_tables as D

from conftest import SF_SMALL


def test_build_marts_incremental_and_tests(spark):
    root = scratch_path(spark, "test-build", uuid.uuid4().hex)
    raw = D.raw_trips(spark, SF_SMALL)
    zones = D.raw_zones(spark, SF_SMALL).withColumn("borough", F.lit("Queens"))
    fact, dim = "t_fct_" + uuid.uuid4().hex[:6], "t_dim_" + uuid.uuid4().hex[:6]
    early = raw.filter(F.col("_loaded_at") <= F.lit("2024-01-21").cast("timestamp"))
    first = build_marts(spark, early, zones, fact, dim, root=root)
    n_first = spark.table(fact).count()
    second = build_marts(spark, raw, zones, fact, dim, root=root)
    third = build_marts(spark, raw, zones, fact, dim, root=root)
    by = lambda res: {r["node"]: r for r in res}
    assert by(first)[fact]["mode"] == "full" and by(first)[fact]["rows_affected"] == n_first
    assert by(second)[fact]["mode"] == "partition_overwrite" and by(second)[fact]["rows_affected"] > 0
    assert by(third)[fact]["rows_affected"] == 0  # rerun without a new batch writes nothing
    tests = {r["node"]: r for r in third if r["kind"] == "test"}
    assert len(tests) == 7
    assert tests["not_null_fct_trips_pickup_at"]["status"] == "pass"
    assert tests["accepted_values_dim_zones_borough"]["status"] == "pass"
    ids = [r.zone_id for r in spark.table(dim).select("zone_id").collect()]
    orphans = spark.table(fact).filter(F.col("pickup_zone_id").isNotNull() & ~F.col("pickup_zone_id").isin(ids)).count()
    assert tests["relationships_fct_trips_pickup_zone_id"]["failures"] == orphans


def test_a_failing_dimension_test_stops_the_build(spark):
    root = scratch_path(spark, "test-build", uuid.uuid4().hex)
    fact, dim = "t_fct_" + uuid.uuid4().hex[:6], "t_dim_" + uuid.uuid4().hex[:6]
    res = build_marts(spark, D.raw_trips(spark, SF_SMALL), D.raw_zones(spark, SF_SMALL), fact, dim, root=root)
    by = {r["node"]: r for r in res}
    assert by["accepted_values_dim_zones_borough"]["status"] == "fail"  # regions are not boroughs
    assert by[fact]["status"] == "skipped" and not spark.catalog.tableExists(fact)
