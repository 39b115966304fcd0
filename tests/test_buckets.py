"""Upserts into a table stored in buckets of its key."""

import pytest
from pyspark.sql import functions as F

from starkiln.operators import incremental as INC


def build(spark, root, name, n=200, buckets=8):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("a").alias("w"))
    df = df.unionAll(spark.createDataFrame([(None, 1, "n")], "k long, v long, w string"))
    INC.incremental(spark, name, df, unique_key="k", key_buckets=buckets, root=root)
    return df


def files(spark, name):
    return set(spark.table(name).inputFiles())


def test_merge_rewrites_touched_buckets_only(spark, root):
    df = build(spark, root, "b_merge")
    before = files(spark, "b_merge")
    delta = spark.createDataFrame([(3, -1, "z"), (5000, 7, "new"), (None, 2, "n")], "k int, v int, w string")
    assert INC.incremental(spark, "b_merge", delta, "merge", "k") == {"mode": "bucket_rewrite", "rows_inserted": 3}
    want = INC.apply_merge(df, delta.select(F.col("k").cast("long"), F.col("v").cast("long"), "w"), "k")
    assert sorted(map(str, spark.table("b_merge").drop(INC.KEY_BUCKET).collect())) == sorted(map(str, want.collect()))
    touched = {f"{INC.KEY_BUCKET}={r[0]}/" for r in delta.select(INC.bucket_of(["k"], 8)).distinct().collect()}
    kept = {f for f in before if not any(t in f for t in touched)}
    assert kept and kept <= files(spark, "b_merge") and len(touched) < 8


def test_scan_is_pruned_to_the_buckets(spark, root):
    build(spark, root, "b_plan")
    delta = spark.createDataFrame([(3, 1)], "k long, v long").withColumn(INC.KEY_BUCKET, INC.bucket_of(["k"], 8))
    scope = INC.touched_buckets(spark.table("b_plan"), delta)
    plan = scope._jdf.queryExecution().executedPlan().toString()
    assert INC.KEY_BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split(f"{INC.KEY_BUCKET}=")[1].split("/")[0] for f in scope.inputFiles()} == {str(delta.first()[INC.KEY_BUCKET])}


def test_update_columns_delete_insert_and_other_keys(spark, root):
    build(spark, root, "b_more", 20)
    INC.incremental(spark, "b_more", spark.createDataFrame([(1, 9, "q")], "k long, v long, w string"), "merge", "k", merge_update_columns=["v"])
    assert [tuple(r) for r in spark.table("b_more").filter("k = 1").select("v", "w").collect()] == [(9, "a")]
    twice = spark.createDataFrame([(2, 1, "x"), (2, 2, "x")], "k long, v long, w string")
    assert INC.incremental(spark, "b_more", twice, "delete+insert", "k")["mode"] == "bucket_rewrite"
    assert spark.table("b_more").filter("k = 2").count() == 2 and spark.table("b_more").count() == 22
    with pytest.raises(ValueError, match="duplicate"):
        INC.incremental(spark, "b_more", twice, "merge", "k")
    assert INC.incremental(spark, "b_more", spark.createDataFrame([(77, 4, "a")], "k long, v long, w string"), "merge", "v")["mode"] == "rewrite"
    assert INC.key_layout(spark, "b_more") == (["k"], 8)
    assert [r.k for r in spark.table("b_more").filter("v = 4").collect()] == [77]
    wider = spark.createDataFrame([(5, 1, "y", True)], "k long, v long, w string, extra boolean")
    INC.incremental(spark, "b_more", wider, "merge", "k", on_schema_change="append_new_columns")
    assert INC.key_layout(spark, "b_more") == (["k"], 8) and spark.table("b_more").filter("extra").count() == 1
    INC.incremental(spark, "b_more", spark.createDataFrame([(1, 1)], "k long, v long"), full_refresh=True, root=root)
    assert INC.key_layout(spark, "b_more") == (["k"], 8) and spark.table("b_more").count() == 1


def test_buckets_need_a_key(spark, root):
    with pytest.raises(ValueError, match="unique_key"):
        INC.incremental(spark, "b_none", spark.range(2), key_buckets=4, root=root)
