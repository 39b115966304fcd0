"""Batch windows as jobs of their own, several at once; counts that come out of the write."""

import pytest
from pyspark.sql import functions as F

from starkiln.operators import incremental as INC

DDL = "k long, at timestamp, p string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, at string, p string").withColumn("at", F.col("at").cast("timestamp"))


def target_rows():
    rows = [(i, f"2024-01-{1 + i % 8:02d} {i % 24:02d}:30:00", f"f{i % 8}") for i in range(80)]
    return rows + [(800, None, "f0"), (801, "2024-01-03 05:00:00", None), (802, "2023-12-31 23:59:59.999999", "f0"),
                   (803, "2024-01-04 00:00:00", "both"), (804, "2024-01-05 00:00:00", "both")]


def delta_rows():
    return [(900 + i, f"2024-01-{2 + i % 6:02d} 12:00:00", f"f{(1 + i % 6) if i % 5 else 'new' + str(i % 6)}") for i in range(30)] + [(999, "2024-02-09 00:00:00", "late")]


def got(spark, name):
    return sorted(map(str, spark.table(name).select("k", F.col("at").cast("string"), "p").collect()))


OPTS = {"event_time": "at", "begin": "2024-01-02", "end": "2024-01-08", "batch_size": "day", "per_batch": True}


def want(spark):
    out = INC.apply_microbatch(frame(spark, target_rows()), frame(spark, delta_rows()), "at", "2024-01-02", "2024-01-08", "day")
    return sorted(map(str, out.select("k", F.col("at").cast("string"), "p").collect()))


@pytest.mark.parametrize("concurrent", [1, 4])
def test_windows_at_once_equal_one_range(spark, root, concurrent):
    name = f"w_conc_{concurrent}"
    INC.incremental(spark, name, frame(spark, target_rows()), partition_by=["p"], root=root, full_refresh=True)
    done = INC.incremental(spark, name, frame(spark, delta_rows()), "microbatch", concurrent=concurrent, **OPTS)
    assert got(spark, name) == want(spark) and done["batches"] == 6


def test_groups_share_no_partition(spark):
    t, d = frame(spark, target_rows()), frame(spark, delta_rows())
    wins = INC.batch_windows("2024-01-02", "2024-01-08")
    groups = INC.independent_windows(wins, t, d, "at", ["p"], "day")
    assert sorted(w for ws, _ in groups for w in ws) == wins and len(groups) > 1
    parts = [p for _, own in groups for p in own]
    assert len(parts) == len(set(parts)) and (None,) in parts
    both = next(ws for ws, own in groups if ("both",) in own)
    assert {w[0].day for w in both} >= {4, 5}


@pytest.mark.parametrize("concurrent", [1, 3])
def test_a_failing_window_leaves_the_others(spark, root, monkeypatch, concurrent):
    name = f"w_fail_{concurrent}"
    INC.incremental(spark, name, frame(spark, target_rows()), partition_by=["p"], root=root, full_refresh=True)
    real, tries = INC._range_scoped_rewrite, []

    def broken(*a):
        if a[7]["begin"].day == 6:
            tries.append(1)
            raise OSError("lost")
        return real(*a)

    monkeypatch.setattr(INC, "_range_scoped_rewrite", broken)
    with pytest.raises(INC.BatchError) as e:
        INC.incremental(spark, name, frame(spark, delta_rows()), "microbatch", concurrent=concurrent, retries=1, **OPTS)
    assert [x[0].day for x in e.value.failed] == [6] and len(tries) == 2
    half = frame(spark, target_rows())
    for lo, hi in (("2024-01-02", "2024-01-06"), ("2024-01-07", "2024-01-08")):
        half = INC.apply_microbatch(half, frame(spark, delta_rows()), "at", lo, hi, "day")
    assert got(spark, name) == sorted(map(str, half.select("k", F.col("at").cast("string"), "p").collect()))
    monkeypatch.setattr(INC, "_range_scoped_rewrite", real)
    lo, hi, _ = e.value.failed[0]
    INC.incremental(spark, name, frame(spark, delta_rows()), "microbatch", **{**OPTS, "begin": lo, "end": hi})
    assert got(spark, name) == want(spark)


def test_counts_come_out_of_the_write(spark, root):
    df = frame(spark, target_rows())
    assert INC.incremental(spark, "w_count", df, partition_by=["p"], root=root, full_refresh=True) == {"mode": "full", "rows_inserted": 85}
    passes = spark.sparkContext.accumulator(0)

    def seen(k):
        passes.add(1)
        return k

    delta = frame(spark, delta_rows() + [(1, None, None)]).withColumn("k", F.udf(seen, "long")("k"))
    done = INC.incremental(spark, "w_count", delta, "delete+insert", "p")
    assert done == {"mode": "partition_overwrite", "rows_inserted": 32}
    assert passes.value == 33  # each row once, the one without a key once more, for its append
    assert INC.incremental(spark, "w_count", delta.limit(0), "delete+insert", "p")["rows_inserted"] == 0
    assert INC.incremental(spark, "w_count", delta, "append")["rows_inserted"] == 32
    INC.incremental(spark, "w_flat", df, root=root, full_refresh=True)
    files = spark.table("w_flat").inputFiles()
    assert INC.incremental(spark, "w_flat", df.limit(0), "append") == {"mode": "append", "rows_inserted": 0}
    assert spark.table("w_flat").inputFiles() == files
