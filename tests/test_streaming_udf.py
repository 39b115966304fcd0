import uuid

from pyspark.sql import functions as F

from starkiln.plans import udf as U
from starkiln.session import scratch_path
from starkiln.sources import driver_tables as D
from starkiln.streaming import refresh, stream_ingest

from conftest import SF_SMALL


def test_stream_ingest_exactly_once(spark):
    base = scratch_path(spark, "test-stream", uuid.uuid4().hex)
    land = D.landing_trips(spark, SF_SMALL)
    cut = F.col("tpep_pickup_datetime") < F.lit("2024-01-15").cast("timestamp_ntz")
    land.filter(cut).write.partitionBy("_source_file").parquet(f"{base}/landing")
    schema = spark.read.parquet(f"{base}/landing").schema
    name = "t_stream_raw_" + uuid.uuid4().hex[:6]
    args = (spark, f"{base}/landing", name, f"{base}/ckpt", schema)
    stream_ingest(*args, root=f"{base}/wh", source_file_col="_source_file")
    n1 = spark.table(name).count()
    assert n1 == land.filter(cut).count()
    stream_ingest(*args, root=f"{base}/wh", source_file_col="_source_file")
    assert spark.table(name).count() == n1  # nothing new: nothing written
    land.filter(~cut).write.mode("append").partitionBy("_source_file").parquet(f"{base}/landing")
    stream_ingest(*args, root=f"{base}/wh", source_file_col="_source_file")
    assert spark.table(name).count() == land.count()


def test_refresh_full(spark):
    name = "t_refresh_" + uuid.uuid4().hex[:6]
    refresh(spark, name, lambda s: s.range(4))
    assert spark.table(name).count() == 4
    refresh(spark, name, lambda s: s.range(2))
    assert spark.table(name).count() == 2


def test_sql_scalar_function(spark):
    U.create_scalar(spark, "add_tax", [("x", "double")], "double", "round(x * 1.1, 2)")
    assert spark.sql("select add_tax(10.0) as v").first().v == 11.0


def test_python_model(spark):
    import pandas as pd

    def model(ctx, s):
        assert not ctx.is_incremental()
        return pd.DataFrame({"a": [1, 2]})

    ctx = U.ModelContext(spark, "t_py_model_" + uuid.uuid4().hex[:6])
    assert U.run_model(spark, model, ctx).count() == 2


def test_refresh_stream_applies_new_rows_once(spark):
    from starkiln.streaming import refresh_stream

    base = scratch_path(spark, "test-refresh-stream", uuid.uuid4().hex)
    spark.range(3).write.parquet(f"{base}/src")
    name = "t_rs_" + uuid.uuid4().hex[:6]
    spark.range(0).write.saveAsTable(name, path=f"{base}/tbl")
    src = spark.readStream.schema("id bigint").parquet(f"{base}/src")
    refresh_stream(src, name, f"{base}/ckpt", transform=lambda b: b.withColumn("id", F.col("id") * 10),
                   available_now=True)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 10, 20]
    refresh_stream(spark.readStream.schema("id bigint").parquet(f"{base}/src"), name, f"{base}/ckpt",
                   transform=lambda b: b.withColumn("id", F.col("id") * 10), available_now=True)
    assert spark.table(name).count() == 3


def test_refresh_incremental_mode(spark):
    name = "t_refresh_inc_" + uuid.uuid4().hex[:6]
    root = scratch_path(spark, "test-refresh-inc", uuid.uuid4().hex)
    refresh(spark, name, lambda s: s.range(3).withColumn("v", F.col("id")), root=root)
    r = refresh(spark, name, lambda s: s.range(2, 5).withColumn("v", F.col("id") * 10), mode="incremental",
                strategy="merge", unique_key="id")
    assert r["rows_inserted"] == 3
    assert sorted((x.id, x.v) for x in spark.table(name).collect()) == [(0, 0), (1, 1), (2, 20), (3, 30), (4, 40)]
