import datetime as dt

from pyspark.sql import functions as F

from starkiln.operators import sinks as SK
from starkiln.operators import tables as TB
from starkiln.session import scratch_path
from starkiln.sources import ingest as ING
from starkiln.sources import seeds as SEED

from conftest import SF_SMALL


def test_target_months_wraps_year():
    assert ING.target_months(today=dt.date(2024, 2, 15)) == ["2023-12"]
    assert ING.target_months(today=dt.date(2024, 1, 1)) == ["2023-11"]
    assert ING.target_months("2023-11,2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]


def test_ingest_projection_lineage_and_micros(spark):
    land = spark.createDataFrame(
        [(1, 1704067200000000, 1704067260000000, None, 2.0)],
        "VendorID int, tpep_pickup_datetime bigint, tpep_dropoff_datetime bigint, Airport_fee double, airport_fee double")
    raw = ING.ingest_trips(land, source_file=F.lit("f.parquet"), loaded_at=F.lit("2024-02-01").cast("timestamp"))
    r = raw.first()
    assert r.tpep_pickup_datetime == dt.datetime(2024, 1, 1) and r.tpep_dropoff_datetime == dt.datetime(2024, 1, 1, 0, 1)
    assert r.Airport_fee == 2.0 and r._source_file == "f.parquet" and r.trip_distance is None
    assert raw.columns[-2:] == ["_source_file", "_loaded_at"] and len(raw.columns) == 21


def test_load_if_absent_and_rows_loaded(spark):
    raw = spark.createDataFrame([(1, "a.parquet"), (2, "b.parquet")], "id int, _source_file string")
    land = spark.createDataFrame([(3, "b.parquet"), (4, "c.parquet")], "id int, _source_file string")
    assert [r.id for r in ING.load_if_absent(raw, land).collect()] == [4]
    assert ING.load_if_absent(raw, land, force=True).count() == 2
    assert ING.rows_loaded(raw, "b.parquet").first().rows_loaded == 1


def test_seed_keeps_leading_zeros(spark):
    path = scratch_path(spark, "test-seed")
    spark.createDataFrame([("007", 1), ("010", 2)], "code string, n int").coalesce(1).write.option(
        "header", True).mode("overwrite").csv(path)
    s = SEED.seed(spark, path, column_types={"code": "string"})
    assert sorted(r.code for r in s.collect()) == ["007", "010"]
    assert dict(s.dtypes)["n"] == "int"


def test_read_zones(spark):
    path = scratch_path(spark, "test-zones")
    spark.createDataFrame([(1, "EWR", "Newark Airport", "EWR")], "a int, b string, c string, d string") \
        .write.option("header", True).mode("overwrite").csv(path)
    z = SEED.read_zones(spark, path)
    assert z.columns == ["locationid", "borough", "zone", "service_zone"] and z.first().locationid == 1


def test_view_table_clone(spark, root):
    df = spark.range(3).withColumn("p", F.col("id") % 2)
    t = SK.as_table(df, "t_sink_a", root=root, partition_by=["p"])
    assert t.count() == 3 and TB.partition_columns(spark, "t_sink_a") == ["p"]
    try:
        SK.as_view(df, "t_sink_a")
        raise AssertionError("expected an error: a table holds the name")
    except ValueError:
        pass
    SK.as_table(df.filter("id > 0"), "t_sink_a", partition_by=["p"])  # a new version, repointed
    assert spark.table("t_sink_a").count() == 2
    c = SK.clone(spark, "t_sink_a", "t_sink_b", root=root)
    assert c.count() == 2
    assert SK.clone(spark, "t_sink_a", "t_sink_b").count() == 2  # exists: no-op
    v = SK.as_view(df, "t_sink_v")
    assert TB.kind(spark, "t_sink_v") == "view" and v.count() == 3
    cl = SK.clustered(df, ["id"])
    assert cl.count() == 3


def test_driver_tables_shapes(spark):
    from starkiln.sources import driver_tables as D

    assert len(D.raw_trips(spark, SF_SMALL).columns) == 21
    assert D.raw_zones(spark, SF_SMALL).count() == 25


def test_bad_row_aborts_the_load(spark):
    import pytest

    land = spark.createDataFrame([("1",), ("not-a-number",)], "VendorID string")
    with pytest.raises(Exception):
        ING.ingest_trips(land, source_file=F.lit("f"), loaded_at=F.current_timestamp()).collect()


def test_load_months_reads_chosen_files(spark):
    base = scratch_path(spark, "test-months")
    for m, n in (("2024-01", 2), ("2024-02", 3), ("2024-03", 4)):
        spark.range(n).selectExpr("cast(id as bigint) as VendorID").coalesce(1).write.mode("overwrite").parquet(
            f"{base}/trips_{m}.parquet")
    raw = ING.load_months(spark, base, ING.target_months("2024-02,2024-03"), loaded_at=F.current_timestamp())
    assert raw.count() == 7
    assert sorted({r._source_file.split("/")[0] for r in raw.select("_source_file").collect()}) == [
        "trips_2024-02.parquet", "trips_2024-03.parquet"]  # the path below the landing folder


def test_load_files_skip_force_replace(spark):
    import uuid

    base = scratch_path(spark, "test-load", uuid.uuid4().hex)
    land = spark.createDataFrame([(1, "f1"), (2, "f1"), (3, "f2")], "VendorID bigint, f string")
    land.write.partitionBy("f").parquet(f"{base}/landing")
    name = "t_load_" + uuid.uuid4().hex[:6]
    kw = dict(root=f"{base}/wh", source_file_col="f")
    rep = ING.load_files(spark, f"{base}/landing", name, **kw)
    assert sorted((r._source_file, r.rows_loaded) for r in rep.collect()) == [("f1", 2), ("f2", 1)]
    assert ING.load_files(spark, f"{base}/landing", name, **kw).count() == 0  # already loaded: skipped
    assert spark.table(name).count() == 3
    ING.load_files(spark, f"{base}/landing", name, force=True, replace=True, **kw)
    assert spark.table(name).count() == 3  # replace is idempotent
    ING.load_files(spark, f"{base}/landing", name, force=True, **kw)
    assert spark.table(name).count() == 6  # a forced append adds a second batch
