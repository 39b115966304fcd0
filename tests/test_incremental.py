import datetime as dt

import pytest
from pyspark.sql import functions as F

from starkiln.operators import incremental as INC
from starkiln.operators import schema_change as SC
from starkiln.operators import tables as TB

SCHEMA = "k string, v int, f string"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def srt(xs):
    return sorted(xs, key=repr)


def test_delete_insert_replaces_keys_keeps_duplicates(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 3, "y"), (None, 4, "z")], SCHEMA)
    d = spark.createDataFrame([("a", 10, "x2"), ("a", 10, "x2"), (None, 5, "n")], SCHEMA)
    out = INC.apply_delete_insert(t, d, "k")
    # both old 'a' rows go, both (duplicate) new rows come in; the NULL-key target row is never deleted
    assert rows(out, "k", "v") == srt([("a", 10), ("a", 10), ("b", 3), (None, 4), (None, 5)])


def test_delete_insert_with_predicates_and_no_key(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("a", 2, "keep")], SCHEMA)
    d = spark.createDataFrame([("a", 9, "new")], SCHEMA)
    out = INC.apply_delete_insert(t, d, ["k"], predicates=["f = 'old'"])
    assert rows(out, "v") == srt([(2,), (9,)])
    assert INC.apply_delete_insert(t, d, None).count() == 3


def test_merge_update_insert_and_columns(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "n")], SCHEMA)
    d = spark.createDataFrame([("a", 10, "x2"), ("c", 30, "z"), (None, 4, "m")], SCHEMA)
    assert rows(INC.apply_merge(t, d, "k"), "k", "v", "f") == srt(
        [("a", 10, "x2"), ("b", 2, "y"), ("c", 30, "z"), (None, 3, "n"), (None, 4, "m")])
    assert rows(INC.apply_merge(t, d, "k", update_columns=["v"]), "k", "v", "f") == srt(
        [("a", 10, "x"), ("b", 2, "y"), ("c", 30, "z"), (None, 3, "n"), (None, 4, "m")])
    assert rows(INC.apply_merge(t, d, "k", exclude_columns=["v"]), "k", "v", "f") == srt(
        [("a", 1, "x2"), ("b", 2, "y"), ("c", 30, "z"), (None, 3, "n"), (None, 4, "m")])
    with pytest.raises(ValueError):
        INC.apply_merge(t, d, "k", update_columns=["v"], exclude_columns=["f"])


def test_merge_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    d = spark.createDataFrame([("a", 2, "x"), ("a", 3, "x")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate"):
        INC.apply_merge(t, d, "k")


def test_merge_predicate_blocks_match(spark):
    t = spark.createDataFrame([("a", 1, "frozen"), ("b", 2, "open")], SCHEMA)
    d = spark.createDataFrame([("a", 10, "new"), ("b", 20, "new")], SCHEMA)
    out = INC.apply_merge(t, d, "k", predicates=["f = 'open'"])
    # 'a' cannot match (predicate false) so the source row is inserted next to it
    assert rows(out, "k", "v") == srt([("a", 1), ("a", 10), ("b", 20)])


def test_insert_overwrite_variants(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", None, "y"), ("c", 5, "z")], SCHEMA)
    d = spark.createDataFrame([("d", 7, "w")], SCHEMA)
    assert rows(INC.apply_insert_overwrite(t, d), "k") == srt([("d",)])
    only_v = INC.apply_insert_overwrite(t, d, columns=["k", "v"])
    assert rows(only_v) == srt([("d", 7, None)])
    # generic variant: rows whose predicate is NULL stay
    out = INC.apply_insert_overwrite(t, d, predicates=["v > 2"], whole_table=False)
    assert rows(out, "k") == srt([("a",), ("b",), ("d",)])


def test_microbatch_replaces_event_time_range(spark):
    sch = "id int, ts timestamp"
    t = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 5)),
                               (3, dt.datetime(2024, 1, 3, 5))], sch)
    d = spark.createDataFrame([(20, dt.datetime(2024, 1, 2, 6)), (30, dt.datetime(2024, 1, 9))], sch)
    out = INC.apply_microbatch(t, d, "ts", "2024-01-02", "2024-01-03", "day")
    assert rows(out, "id") == srt([(1,), (3,), (20,)])
    assert len(INC.batch_windows("2024-01-30", "2024-03-02", "month")) == 3


def test_schema_change_modes(spark):
    t = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    d = spark.createDataFrame([("b", "2", 7)], "k string, v string, extra int")  # f missing, v retyped, extra new
    t2, d2 = SC.reconcile(t, d, "ignore")
    assert t2.columns == ["k", "v", "f"] and rows(d2) == [("b", 2, None)]
    t2, d2 = SC.reconcile(t, d, "append_new_columns")
    assert d2.columns == ["k", "v", "f", "extra"] and rows(t2) == [("a", 1, "x", None)]
    t2, d2 = SC.reconcile(t, d, "sync_all_columns")
    assert t2.columns == ["k", "v", "extra"] and t2.schema["v"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        SC.reconcile(t, d, "fail")
    logged = []
    t2, _ = SC.reconcile(t, d, "bogus", log=logged.append)
    assert logged and t2.columns == ["k", "v", "f"]


def test_widening_is_not_a_change(spark):
    t = spark.createDataFrame([(1,)], "v bigint")
    d = spark.createDataFrame([(1,)], "v int")
    assert not SC.diff(t.schema, d.schema).any


def test_materialization_partition_overwrite_idempotent(spark, root):
    name = "t_inc_part"
    sch = "id int, _source_file string, _loaded_at timestamp"
    t0 = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([(1, "f1", t0), (2, "f1", t0), (3, "f2", t0)], sch)
    assert INC.incremental(spark, name, first, partition_by=["_source_file"], root=root)["mode"] == "full"
    reload = spark.createDataFrame([(10, "f1", t0 + dt.timedelta(days=1))], sch)
    for _ in range(2):  # the same reload twice: same result
        r = INC.incremental(spark, name, reload, "delete+insert", "_source_file")
        assert r["mode"] == "partition_overwrite"
        assert rows(spark.table(name), "id", "_source_file") == srt([(3, "f2"), (10, "f1")])
    empty = spark.createDataFrame([], sch)
    assert INC.incremental(spark, name, empty, "delete+insert", "_source_file")["rows_inserted"] == 0
    assert spark.table(name).count() == 2


def test_materialization_rewrite_and_view_in_the_way(spark, root):
    name = "t_inc_merge"
    spark.range(1).createOrReplaceTempView(name)
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    assert INC.incremental(spark, name, t, "merge", "k", root=root)["mode"] == "full"
    assert TB.kind(spark, name) == "table"
    d = spark.createDataFrame([("b", 20, "y2"), ("c", 3, "z")], SCHEMA)
    INC.incremental(spark, name, d, "merge", "k")
    INC.incremental(spark, name, d, "merge", "k")  # idempotent
    assert rows(spark.table(name), "k", "v") == srt([("a", 1), ("b", 20), ("c", 3)])
    new_col = d.withColumn("w", F.lit(1.5))
    INC.incremental(spark, name, new_col, "append", on_schema_change="append_new_columns")
    assert "w" in spark.table(name).columns and spark.table(name).count() == 5
    assert INC.incremental(spark, name, t, full_refresh=True)["mode"] == "full"
    assert spark.table(name).count() == 2


def test_stable_delta_survives_target_change(spark, root):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    s = INC.stable(df)
    assert rows(s) == rows(df)


def test_latest_batch_per_file_including_null_file(spark):
    from starkiln.operators.filters import latest_batch

    sch = "id int, _source_file string, _loaded_at timestamp"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, "a", t1), (2, "a", t2), (3, "b", t1), (4, None, t1), (5, None, t2)], sch)
    assert rows(latest_batch(df), "id") == srt([(2,), (3,), (5,)])


def test_partition_scoped_merge_and_delete_insert(spark, root):
    name = "t_inc_scoped"
    sch = "p string, k int, v int"
    base = spark.createDataFrame([("x", 1, 1), ("x", 2, 2), ("y", 1, 3), (None, 5, 5)], sch)
    INC.incremental(spark, name, base, partition_by=["p"], root=root)
    d = spark.createDataFrame([("x", 2, 20), ("x", 3, 30)], sch)
    r = INC.incremental(spark, name, d, "merge", ["p", "k"])
    assert r["mode"] == "partition_rewrite"
    assert rows(spark.table(name), "p", "k", "v") == srt([("x", 1, 1), ("x", 2, 20), ("x", 3, 30), ("y", 1, 3),
                                                         (None, 5, 5)])
    d2 = spark.createDataFrame([("y", 1, 99), ("y", 1, 98), (None, 5, 50)], sch)
    r = INC.incremental(spark, name, d2, "delete+insert", ["p", "k"])
    assert r["mode"] == "partition_rewrite"
    # NULL partition value: the key (p, k) has a NULL part, so nothing is deleted and the row is added
    assert rows(spark.table(name), "p", "k", "v") == srt([("x", 1, 1), ("x", 2, 20), ("x", 3, 30), ("y", 1, 99),
                                                         ("y", 1, 98), (None, 5, 5), (None, 5, 50)])


def test_snapshot_table_versions(spark, root):
    from starkiln.operators.snapshot import snapshot_table

    sch = "id int, v string, updated_at timestamp"
    v1 = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], sch)
    v2 = spark.createDataFrame([(1, "b", dt.datetime(2024, 2, 1))], sch)
    snapshot_table(spark, "t_snap", v1, "id", root=root, updated_at="updated_at")
    assert snapshot_table(spark, "t_snap", v2, "id", updated_at="updated_at")["rows"] == 2
    assert snapshot_table(spark, "t_snap", v2, "id", updated_at="updated_at")["rows"] == 2


def test_partition_scoped_microbatch_and_overwrite_clear_emptied_partitions(spark, root):
    name = "t_inc_mb"
    sch = "d date, id int, ts timestamp"
    mk = lambda day, i, h=5: (dt.date(2024, 1, day), i, dt.datetime(2024, 1, day, h))
    base = spark.createDataFrame([mk(1, 1), mk(2, 2), mk(2, 3), mk(3, 4)], sch)
    INC.incremental(spark, name, base, partition_by=["d"], root=root)
    # batch [Jan 2, Jan 3): day-2 rows replaced by the one delta row of that day; Jan 9 is out of range
    delta = spark.createDataFrame([mk(2, 20, 7), mk(9, 90)], sch)
    r = INC.incremental(spark, name, delta, "microbatch", event_time="ts", begin="2024-01-02", end="2024-01-03")
    assert r["mode"] == "partition_rewrite"
    assert rows(spark.table(name), "id") == srt([(1,), (4,), (20,)])
    # generic insert_overwrite with a predicate that empties day 3 and writes into day 5
    new = spark.createDataFrame([mk(5, 50)], sch)
    r = INC.incremental(spark, name, new, "insert_overwrite", predicates=["id = 4"], whole_table=False)
    assert r["mode"] == "partition_rewrite"
    assert rows(spark.table(name), "id") == srt([(1,), (20,), (50,)])
    # an empty range leaves the table as it is
    r = INC.incremental(spark, name, new.filter("false"), "microbatch", event_time="ts", begin="2024-02-01",
                        end="2024-02-02")
    assert rows(spark.table(name), "id") == srt([(1,), (20,), (50,)])


def test_rewrite_with_schema_change_updates_the_table_definition(spark, root):
    name = "t_inc_sync"
    t = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    INC.incremental(spark, name, t, root=root)
    d = spark.createDataFrame([("a", "10", 2.5), ("b", "20", 3.5)], "k string, v string, w double")  # f gone
    INC.incremental(spark, name, d, "merge", "k", on_schema_change="sync_all_columns")
    out = spark.table(name)
    assert out.columns == ["k", "v", "w"] and dict(out.dtypes)["v"] == "string"
    assert rows(out) == srt([("a", "10", 2.5), ("b", "20", 3.5)])
    # full refresh with a different partition spec
    INC.incremental(spark, name, d, full_refresh=True, partition_by=["k"])
    assert TB.partition_columns(spark, name) == ["k"] and spark.table(name).count() == 2


def test_microbatch_per_batch_equals_one_pass(spark, root):
    sch = "d date, id int, ts timestamp"
    mk = lambda day, i, h=5: (dt.date(2024, 1, day), i, dt.datetime(2024, 1, day, h))
    base = spark.createDataFrame([mk(1, 1), mk(2, 2), mk(3, 3), mk(4, 4)], sch)
    delta = spark.createDataFrame([mk(2, 20, 6), mk(3, 30, 7), mk(3, 31, 8)], sch)
    out = {}
    for per_batch in (False, True):
        name = f"t_mb_{int(per_batch)}"
        INC.incremental(spark, name, base, partition_by=["d"], root=root)
        r = INC.incremental(spark, name, delta, "microbatch", event_time="ts", begin="2024-01-02",
                            end="2024-01-04", per_batch=per_batch)
        out[per_batch] = rows(spark.table(name), "id")
        if per_batch:
            assert r["batches"] == 2
    assert out[True] == out[False] == srt([(1,), (4,), (20,), (30,), (31,)])


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@pytest.mark.parametrize("name", ["inc_03", "inc_03_update_columns", "inc_03_exclude_columns", "inc_03_buckets", "inc_06", "inc_06_default"])
def test_merge_queries_take_keys_from_zero_down(spark, root, name):
    # the new rows of keys -2 and 0 would get keys 1 and 3, which changed orders have already; that of -1 gets 2
    at = dt.datetime(1996, 1, 2)
    o = [(-2, 1, "O", 1.0, at, "1-URGENT"), (-1, 2, "O", 2.0, at, "1-URGENT"), (0, 3, "O", 3.0, at, "1-URGENT"),
         (1, 4, "F", 4.0, at, "5-LOW"), (2, 5, "O", 5.0, at, "5-LOW"), (3, 6, "F", 6.0, at, "5-LOW"), (None, 7, "O", 7.0, at, "1-URGENT")]
    spark.createDataFrame(o, ORDERS).write.parquet(f"{root}/orders.parquet")
    from starkiln.plans.registry import REGISTRY

    got = {(r["o_orderkey"], r["o_totalprice"]) for r in REGISTRY[name](spark, root).collect()}
    assert got == {(-2, 1.0), (-1, 2.0), (0, 3.0), (1, 5.0), (2, 2.0), (3, 7.0), (None, 7.0), (-5, 1.0), (-3, 3.0)}
