"""Rows must not be lost or doubled by late files, changed lookups, time zones or failed runs."""

import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from starkiln.operators import incremental as INC
from starkiln.operators import joins as J
from starkiln.operators import snapshot as SCD
from starkiln.operators import tables as TB
from starkiln.sources import driver_tables as D
from starkiln.sources import ingest as ING
from starkiln.streaming import stream_ingest

from conftest import SF_SMALL


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def landed(spark, rows=None):
    trips = D.landing_trips(spark, SF_SMALL).drop("_source_file", "_loaded_at")
    return trips if rows is None else trips.limit(rows)


def test_equal_base_names_and_late_parts_are_all_loaded(spark, root):
    t, table = landed(spark, 300).cache(), name("raw")
    half = F.col("PULocationID") % 2 == 0
    for folder, rows in (("y=2024/m=01", t.filter(half)), ("y=2024/m=02", t.filter(~half))):
        rows.coalesce(1).write.parquet(f"{root}/tmp/{folder}")
        os.makedirs(f"{root}/landing/{folder}".removeprefix("file:"))
        src = [f for f in os.listdir(f"{root}/tmp/{folder}".removeprefix("file:")) if f.endswith(".parquet")][0]
        os.link(f"{root}/tmp/{folder}/{src}".removeprefix("file:"), f"{root}/landing/{folder}/trips.parquet".removeprefix("file:"))
    got = ING.load_files(spark, f"{root}/landing", table, root=f"{root}/wh")
    assert got.agg(F.sum("rows_loaded")).first()[0] == 300 and got.count() == 2
    assert {r[0] for r in got.select("_source_file").collect()} == {"y=2024/m=01/trips.parquet", "y=2024/m=02/trips.parquet"}
    t.limit(50).coalesce(1).write.mode("append").parquet(f"{root}/landing/y=2024/m=02")
    again = ING.load_files(spark, f"{root}/landing", table, root=f"{root}/wh")
    assert again.agg(F.sum("rows_loaded")).first()[0] == 50
    assert ING.load_files(spark, f"{root}/landing", table, root=f"{root}/wh").count() == 0
    assert spark.table(table).count() == 350
    stream = name("raw_stream")
    schema = spark.read.parquet(f"{root}/landing").schema
    stream_ingest(spark, f"{root}/landing", stream, f"{root}/ckpt", schema, root=f"{root}/wh", max_files_per_trigger=1)
    assert spark.table(stream).count() == 350


def test_a_changed_lookup_is_seen(spark, root):
    child = spark.range(5).select(F.col("id").alias("k"))
    path = f"{root}/parents"
    spark.range(2).select(F.col("id").alias("k")).write.parquet(path)
    assert J.orphans(child, spark.read.parquet(path), "k").count() == 3
    spark.range(2, 5).select(F.col("id").alias("k")).write.mode("append").parquet(path)
    assert J.orphans(child, spark.read.parquet(path), "k").count() == 0


def test_many_partitions_of_two_columns(spark, root):
    table = name("wide")
    rows = spark.range(700).select((F.col("id") % 35).cast("int").alias("a"), (F.col("id") / 35).cast("int").alias("b"),
                                   F.col("id").alias("k"), F.lit(0).alias("v"))
    INC.incremental(spark, table, rows.coalesce(1), partition_by=["a", "b"], root=root)
    INC.incremental(spark, table, rows.withColumn("v", F.lit(1)).coalesce(1), "merge", ["a", "b", "k"])
    assert spark.table(table).agg(F.count("*"), F.sum("v")).first() == (700, 700)


def test_per_batch_with_a_null_partition(spark, root):
    table = name("nulls")
    rows = spark.sql("select 1 as id, cast(null as string) as p, timestamp'2024-01-02 01:00:00' as ts union all "
                     "select 2, 'x', timestamp'2024-01-03 01:00:00'")
    INC.incremental(spark, table, rows, partition_by=["p"], root=root)
    new = spark.sql("select 3 as id, 'x' as p, timestamp'2024-01-02 05:00:00' as ts")
    INC.incremental(spark, table, new, "microbatch", root=root, event_time="ts", begin="2024-01-02", end="2024-01-04", per_batch=True)
    assert sorted(r.id for r in spark.table(table).collect()) == [3]


def test_split_snapshot_can_be_run_again_after_a_failure(spark, root, monkeypatch):
    table = name("hist")
    kw = dict(strategy="check", check_cols=["v"], root=root, layout="split")
    one, two = spark.sql("select 1 as id, 'a' as v union all select 2, 'b'"), spark.sql("select 1 as id, 'z' as v union all select 2, 'b'")
    SCD.snapshot_table(spark, table, one, "id", now="2024-01-01 00:00:00", **kw)
    write, calls = TB.write_version, []

    def fail(df, target, *args, **kwargs):
        calls.append(target)
        if target.endswith("__open"):
            raise RuntimeError("lost")
        return write(df, target, *args, **kwargs)

    monkeypatch.setattr(TB, "write_version", fail)
    with pytest.raises(RuntimeError):
        SCD.snapshot_table(spark, table, two, "id", now="2024-02-01 00:00:00", **kw)
    monkeypatch.setattr(TB, "write_version", write)
    SCD.snapshot_table(spark, table, two, "id", now="2024-03-01 00:00:00", **kw)
    got = sorted((r.id, r.v, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in spark.table(table).collect())
    assert got == [(1, "a", "2024-01-01", "2024-03-01"), (1, "z", "2024-03-01", "None"), (2, "b", "2024-01-01", "None")]


def test_snapshot_runs_one_join(spark):
    h = SCD.snapshot(spark.sql("select 1 as id, 'a' as v"), None, "id", "check", now="2024-01-01 00:00:00")
    out = SCD.snapshot(spark.sql("select 1 as id, 'b' as v"), h, "id", "check", now="2024-02-01 00:00:00", hard_deletes="new_record")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


ZONE = """
import sys
sys.path.insert(0, {repo!r})
from starkiln.session import local_session
from starkiln.operators import filters as FL, incremental as INC
from starkiln.functions.generators import date_spine
s = local_session("2", shuffle_partitions=2)
for kind in ("timestamp", "timestamp_ntz"):
    t = s.sql(f"select 1 as id, {{kind}}'2024-01-25 23:30:00' as ts union all select 2, {{kind}}'2024-01-26 00:30:00'")
    d = s.sql(f"select 10 as id, {{kind}}'2024-01-25 00:10:00' as ts union all select 11, {{kind}}'2024-01-27 00:00:00'")
    out = INC.apply_microbatch(t, d, "ts", "2024-01-25", "2024-01-26", "day")
    assert sorted(r.id for r in out.collect()) == [2, 10], kind
    newer = s.sql(f"select 3 as id, {{kind}}'2024-01-26 00:30:00.000001' as ts union all select 4, {{kind}}'2024-01-26 00:30:00'")
    assert [r.id for r in FL.since_watermark(newer, t, "ts").collect()] == [3], kind
hours = date_spine(s, "hour", "2024-03-10T01:00:00", "2024-03-10T04:00:00")
assert [r[0] for r in hours.selectExpr("cast(date_hour as string)").collect()] == [f"2024-03-10 0{{h}}:00:00" for h in (1, 2, 3)]
print("zone ok")
"""


def test_time_zone_of_the_driver_host_has_no_say():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-c", ZONE.format(repo=repo)], env=os.environ | {"TZ": "America/New_York"},
                       capture_output=True, text=True, timeout=300)
    assert "zone ok" in r.stdout, r.stderr[-2000:]


def test_a_rewrite_of_a_partitioned_table_replaces_every_partition(spark, root):
    table = name("versions")
    rows = spark.sql("select 1 as id, 'x' as p union all select 2, cast(null as string) union all select 3, 'y'")
    INC.incremental(spark, table, rows, partition_by=["p"], root=root)
    TB.write_version(spark.sql("select 10 as id, 'x' as p"), table, root, ["p"])
    assert [r.id for r in spark.table(table).collect()] == [10]
