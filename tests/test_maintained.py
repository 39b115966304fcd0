"""Aggregates kept from partials, and tables with refresh settings."""

import random

import pytest
from pyspark.sql import functions as F

from starkiln.operators import tables as TB
from starkiln.streaming import Measure, alter_refreshed, create_refreshed, maintain_aggregate, refresh_if_due

MEASURES = [Measure("n", "count"), Measure("filled", "count", "v"), Measure("s", "sum", "v"), Measure("m", "avg", "v", 4),
            Measure("lo", "min", "v"), Measure("hi", "max", "t")]
SHAPE = "f string, k string, v int, t string"


def full(rows):
    return rows.groupBy("k").agg(F.count("*").alias("n"), F.count("v").alias("filled"), F.sum("v").alias("s"),
                                 F.round(F.avg("v"), 4).alias("m"), F.min("v").alias("lo"), F.max("t").alias("hi"))


def test_equal_to_a_full_recompute(spark, root):
    rng = random.Random(4)
    files, version = {}, {}

    def put(f, n):
        files[f] = [(f, rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(-9, 9)]), rng.choice("xyz")) for _ in range(n)]
        version[f] = str(rng.random())

    for step in range(5):
        put(f"f{step}", rng.randint(0, 12))
        put("f0", rng.randint(1, 6))
        if step == 3:
            del files["f1"], version["f1"]
        rows = spark.createDataFrame([r for x in files.values() for r in x], SHAPE)
        now = spark.createDataFrame(list(version.items()), "f string, version string")
        maintain_aggregate(spark, "kept_random", rows, "f", ["k"], MEASURES, now, root=root)
        want, got = full(rows), spark.table("kept_random")
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())), step


def test_reads_only_changed_parts(spark, root):
    rows = spark.createDataFrame([("a", "x", 1, "t"), ("b", "x", 2, "t"), ("c", "y", 3, "t")], SHAPE)
    TB.write_version(rows, "kept_source", root, partition_by=["f"])
    at = lambda **v: spark.createDataFrame(list(v.items()), "f string, version string")
    read = []

    class Watched:  # what of the source the run asks for
        def filter(self, cond):
            out = spark.table("kept_source").filter(cond)
            read.append(sorted({p.split("f=")[1].split("/")[0] for p in out.select("v").inputFiles()}))
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [" in plan and "f" in plan.split("PartitionFilters: [")[1].split("]")[0]
            return out

    maintain_aggregate(spark, "kept_pruned", spark.table("kept_source"), "f", ["k"], MEASURES, at(a="1", b="1", c="1"), root=root)
    assert maintain_aggregate(spark, "kept_pruned", Watched(), "f", ["k"], MEASURES, at(a="1", b="2", c="1"), root=root)["parts_read"] == 1
    assert read == [["b"]]
    assert maintain_aggregate(spark, "kept_pruned", Watched(), "f", ["k"], MEASURES, at(a="1", b="2", c="1"), root=root)["mode"] == "noop"
    assert maintain_aggregate(spark, "kept_pruned", Watched(), "f", ["k"], MEASURES, at(b="2"), root=root) == {"mode": "incremental", "parts_read": 0}
    assert [tuple(r)[:2] for r in spark.table("kept_pruned").collect()] == [("x", 1)] and len(read) == 1


def test_measures_that_do_not_merge_are_refused():
    with pytest.raises(ValueError, match="mergeable"):
        Measure("x", "median", "v")
    with pytest.raises(ValueError, match="column"):
        Measure("x", "sum")


def test_lag_initialize_and_alter(spark, root):
    model = lambda s: s.range(3)
    assert create_refreshed(spark, "lagged", model, "1 hour", initialize="on_schedule", root=root) == {"initialized": False}
    assert spark.table("lagged").count() == 0
    assert refresh_if_due(spark, "lagged", model, root=root) == {"mode": "full"} and spark.table("lagged").count() == 3
    assert refresh_if_due(spark, "lagged", lambda s: s.range(9), root=root) == {"mode": "fresh"} and spark.table("lagged").count() == 3
    alter_refreshed(spark, "lagged", target_lag="0 seconds")
    assert spark.table("lagged").count() == 3
    assert refresh_if_due(spark, "lagged", lambda s: s.range(9), root=root) == {"mode": "full"} and spark.table("lagged").count() == 9
    alter_refreshed(spark, "lagged", mode="incremental")
    assert refresh_if_due(spark, "lagged", lambda s: s.range(9, 11), strategy="append")["mode"] == "append"
    assert spark.table("lagged").count() == 11
    with pytest.raises(ValueError):
        create_refreshed(spark, "lagged2", model, "1 hour", initialize="never", root=root)
