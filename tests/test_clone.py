"""Clones that share the files of their source until one side is written."""

import pytest
from pyspark.sql import functions as F

from starkiln.operators import incremental as INC
from starkiln.operators import sinks as SK
from starkiln.operators import tables as TB


def build(spark, root, name, parts=("p",)):
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), (F.col("id") % 4).cast("int").alias("p"))
    SK.as_table(df, name, root=root, partition_by=list(parts))
    return df


def rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("k", "v", "p").collect())


def files(spark, name):
    return set(spark.table(name).inputFiles())


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_no_file_is_written(spark, root, parts):
    build(spark, root, "c_src", parts)
    SK.clone(spark, "c_src", "c_dst", shallow=True, full_refresh=True, root=root)
    assert files(spark, "c_dst") == files(spark, "c_src") and rows(spark, "c_dst") == rows(spark, "c_src")
    assert TB.partition_columns(spark, "c_dst") == list(parts)


@pytest.mark.parametrize("side", ["c1_src", "c1_dst"])
@pytest.mark.parametrize("write", ["append", "partitions", "clear", "rewrite"])
@pytest.mark.parametrize("parts", [(), ("p",)])
def test_writes_stay_on_their_side(spark, root, side, write, parts):
    if not parts and write in ("partitions", "clear"):
        pytest.skip("needs partitions")
    build(spark, root, "c1_src", parts)
    SK.clone(spark, "c1_src", "c1_dst", shallow=True, full_refresh=True, root=root)
    other = {"c1_src": "c1_dst", "c1_dst": "c1_src"}[side]
    before, of_other = rows(spark, other), files(spark, other)
    new = spark.createDataFrame([(900, 1, 2)], "k long, v long, p int")
    if write == "append":
        want = before + [(900, 1, 2)]
        INC.incremental(spark, side, new, "append")
        INC.incremental(spark, side, new.limit(0), "append")
    elif write == "partitions":
        want = [r for r in before if r[2] != 2] + [(900, 1, 2)]
        INC.incremental(spark, side, new, "delete+insert", "p")
    elif write == "clear":
        want = [r for r in before if r[2] != 1]
        TB.clear_partitions(spark, side, [{"p": 1}])
    else:
        want = [(900, 1, 2)]
        INC.incremental(spark, side, new, "insert_overwrite", whole_table=True)
    assert rows(spark, side) == sorted(want)
    spark.catalog.refreshTable(other)
    assert rows(spark, other) == before and files(spark, other) == of_other
    assert not files(spark, side) & of_other
    assert "/" + side.replace(".", "/") + "/" in TB.location(spark, side)


def test_a_clone_of_buckets_keeps_them(spark, root):
    df = spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v"))
    INC.incremental(spark, "c2_src", df, unique_key="k", key_buckets=4, root=root, full_refresh=True)
    SK.clone(spark, "c2_src", "c2_dst", shallow=True, full_refresh=True, root=root)
    done = INC.incremental(spark, "c2_dst", spark.createDataFrame([(3, 33)], "k long, v long"), "merge", "k")
    assert done["mode"] == "bucket_rewrite" and INC.key_layout(spark, "c2_dst") == (["k"], 4)
    assert spark.table("c2_dst").filter("k = 3").first().v == 33 and spark.table("c2_src").filter("k = 3").first().v == 3
    assert TB.properties(spark, "c2_dst").get("shared_files") is None


def test_a_clone_of_a_clone_and_of_a_view(spark, root):
    build(spark, root, "c3_a")
    SK.clone(spark, "c3_a", "c3_b", shallow=True, full_refresh=True, root=root)
    SK.clone(spark, "c3_b", "c3_c", shallow=True, full_refresh=True, root=root)
    before = rows(spark, "c3_a")
    INC.incremental(spark, "c3_b", spark.createDataFrame([(7, 7, 9)], "k long, v long, p int"), "append")
    assert rows(spark, "c3_a") == rows(spark, "c3_c") == before and len(rows(spark, "c3_b")) == 41
    SK.clone(spark, "c3_b", "c3_c", shallow=True, root=root)  # it exists: left as it is
    assert rows(spark, "c3_c") == before
    spark.range(2).createOrReplaceTempView("c3_view")
    with pytest.raises(ValueError, match="no table"):
        SK.clone(spark, "c3_view", "c3_d", shallow=True)
