"""Landing files as they come: vintages, odd names, replaced files."""

import os

import pytest
from pyspark.sql import functions as F

from starkiln.operators import filters as FL
from starkiln.operators import snapshot as SCD
from starkiln.plans.registry import _write_file
from starkiln.sources import ingest as ING
from starkiln.sources import ledger as LG

ODD = ["a b.parquet", "c%20d.parquet", "e#f.parquet", "ü+x.parquet", "g%.parquet", "h[1]{2}.parquet"]


def trips(spark, n, count_type="double", time_type="timestamp_ntz", fee="Airport_fee"):
    at = F.lit(1_704_067_200_000_000) + F.col("id") * 1_000_000
    times = F.timestamp_micros(at).cast("timestamp_ntz") if time_type == "timestamp_ntz" else at
    return spark.range(n).select(F.col("id").alias("VendorID"), times.alias("tpep_pickup_datetime"),
                                 F.lit(2).cast(count_type).alias("passenger_count"), F.lit(1.25).alias(fee))


def totals(spark, table):
    rows = spark.table(table).groupBy("_source_file").agg(F.count("*"), F.sum("passenger_count"), F.sum("Airport_fee"),
                                                         F.min("tpep_pickup_datetime").cast("string")).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_odd_names_vintages_and_later_loads(spark, root):
    kinds = [("double", "timestamp_ntz", "Airport_fee"), ("bigint", "timestamp_ntz", "airport_fee"), ("int", "bigint", "Airport_fee")]
    for step, names in enumerate((ODD[:4], ODD)):
        for i, name in enumerate(ODD):
            if name in names and not (step and i < 4):
                _write_file(trips(spark, 3 + i, *kinds[i % 3]), f"{root}/landing/{name}")
        got = ING.load_files(spark, f"{root}/landing", "odd_names", root=f"{root}/wh").collect()
        assert sorted(r._source_file for r in got) == sorted(names if not step else ODD[4:])
    assert totals(spark, "odd_names") == {n: (3 + i, 2.0 * (3 + i), 1.25 * (3 + i), "2024-01-01 00:00:00") for i, n in enumerate(ODD)}
    assert ING.load_files(spark, f"{root}/landing", "odd_names", root=f"{root}/wh").count() == 0


def test_replaced_file_is_read_again_and_the_rest_is_not(spark, root):
    for n in ("x.parquet", "y.parquet"):
        _write_file(trips(spark, 4), f"{root}/landing/{n}")
    ING.load_files(spark, f"{root}/landing", "replaced", root=f"{root}/wh")
    before = {f for f in spark.table("replaced").inputFiles() if "x.parquet" in f}
    _write_file(trips(spark, 7), f"{root}/landing/y.parquet")
    todo = LG.to_read(LG.listing(spark, [f"{root}/landing"], f"{root}/landing"), "replaced").collect()
    assert [r._source_path for r in todo] == ["y.parquet"]
    ING.load_files(spark, f"{root}/landing", "replaced", root=f"{root}/wh")
    assert {k: v[0] for k, v in totals(spark, "replaced").items()} == {"x.parquet": 4, "y.parquet": 7}
    assert {f for f in spark.table("replaced").inputFiles() if "x.parquet" in f} == before


def test_vintages_are_read_apart(spark, root):
    for i, kind in enumerate(["double", "double", "bigint", "bigint", "double"]):
        _write_file(trips(spark, 2, kind), f"{root}/landing/{i}.parquet")
    groups = ING.vintages(spark, [f"{root}/landing/{i}.parquet" for i in range(5)])
    assert sorted((s["passenger_count"].dataType.simpleString(), len(p)) for s, p in groups) == [("bigint", 2), ("double", 3)]


def test_malformed_value_aborts_the_whole_load(spark, root):
    _write_file(trips(spark, 2), f"{root}/landing/a.parquet")
    _write_file(trips(spark, 2, "string").withColumn("passenger_count", F.lit("two")), f"{root}/landing/b.parquet")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ING.load_files(spark, f"{root}/landing", "malformed", root=f"{root}/wh")
    assert not spark.catalog.tableExists("malformed")


def test_table_of_an_earlier_layout_gets_a_ledger(spark, root):
    _write_file(trips(spark, 2), f"{root}/landing/a.parquet")
    ING.load_files(spark, f"{root}/landing", "earlier", root=f"{root}/wh")
    spark.sql("drop table earlier__files")
    _write_file(trips(spark, 3), f"{root}/landing/b.parquet")
    got = ING.load_files(spark, f"{root}/landing", "earlier", root=f"{root}/wh").collect()
    assert [(r._source_file, r.rows_loaded) for r in got] == [("b.parquet", 3)]


def test_per_file_watermark_groups_null_files(spark):
    rows = spark.createDataFrame([(None, "2024-01-02"), ("a", "2024-01-02"), (None, "2024-01-03")], "f string, t string").select("f", F.col("t").cast("timestamp").alias("t"))
    target = rows.filter("t < '2024-01-03'")
    assert [r.f for r in FL.since_watermark(rows, target, "t", per_part="f").collect()] == [None]


def test_snapshot_refuses_repeated_keys(spark):
    src = spark.createDataFrame([(1, 5, "2024-01-01")], "k int, v int, u string").withColumn("u", F.col("u").cast("timestamp"))
    twice = src.withColumn("u", F.col("u") + F.expr("interval 1 day")).unionAll(src)
    hist = SCD.snapshot(src, None, "k", updated_at="u")
    with pytest.raises(ValueError, match="duplicate"):
        SCD.snapshot(twice, hist, "k", updated_at="u")
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k int, v int").withColumn("u", F.lit("2024-01-02").cast("timestamp"))
    assert SCD.snapshot(nulls, hist, "k", updated_at="u").count() == 3


@pytest.mark.parametrize("how", ["load", "stream"])
def test_large_file_is_written_in_pieces(spark, root, monkeypatch, how):
    """A write task sorts what it gets: a file of many rows is not one task's, in the first load and when it is replaced."""
    from starkiln.streaming import stream_ingest

    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    was = {k: spark.conf.get(k) for k in small}
    monkeypatch.setattr(ING, "CHUNK_ROWS", 100)
    table, wh = f"pieces_{how}", f"{root}/wh"
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        for n in (2000, 1500):
            _write_file(trips(spark, n), f"{root}/landing/big.parquet")
            if how == "load":
                assert [r.rows_loaded for r in ING.load_files(spark, f"{root}/landing", table, root=wh).collect()] == [n]
            else:
                stream_ingest(spark, f"{root}/landing", table, f"{root}/checkpoint", trips(spark, 1).schema, root=wh)
            t = spark.table(table)
            assert t.count() == n and t.agg(F.sum("VendorID")).first()[0] == n * (n - 1) // 2
            assert ING.CHUNK not in t.columns and len(t.inputFiles()) > 2
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
