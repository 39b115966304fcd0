import datetime as dt

import pytest
from pyspark.sql import functions as F

from starkiln.operators.snapshot import snapshot

SCH = "id int, v string, updated_at timestamp"
T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def open_rows(h):
    return sorted((r.id, r.v) for r in h.filter(F.col("valid_to").isNull()).collect())


def test_timestamp_strategy_lifecycle(spark):
    v1 = spark.createDataFrame([(1, "a", T1), (2, "b", T1), (3, "c", T1)], SCH)
    h1 = snapshot(v1, None, "id", updated_at="updated_at", now=T1)
    assert h1.count() == 3 and open_rows(h1) == [(1, "a"), (2, "b"), (3, "c")]
    v2 = spark.createDataFrame([(1, "a", T1), (2, "B", T2), (4, "d", T2)], SCH)
    h2 = snapshot(v2, h1, "id", updated_at="updated_at", hard_deletes="invalidate", now=T2).cache()
    assert open_rows(h2) == [(1, "a"), (2, "B"), (4, "d")]
    closed = {(r.id, r.v): r.valid_to for r in h2.filter(F.col("valid_to").isNotNull()).collect()}
    assert closed == {(2, "b"): T2, (3, "c"): T2}
    # same source again: nothing changes
    h3 = snapshot(v2, h2, "id", updated_at="updated_at", hard_deletes="invalidate", now=T3)
    assert sorted(map(tuple, h3.collect())) == sorted(map(tuple, h2.collect()))


def test_check_strategy_null_safe(spark):
    v1 = spark.createDataFrame([(1, None, T1), (2, "b", T1)], SCH).drop("updated_at")
    h1 = snapshot(v1, None, "id", "check", check_cols=["v"], now=T1)
    v2 = spark.createDataFrame([(1, None, T1), (2, None, T1)], SCH).drop("updated_at")
    h2 = snapshot(v2, h1, "id", "check", check_cols=["v"], now=T2)
    assert h2.count() == 3  # only id 2 changed (b -> NULL); NULL == NULL is no change
    assert h2.filter("id = 2 and valid_from = timestamp'2024-02-01'").count() == 1


def test_new_check_column_marks_all_changed(spark):
    v1 = spark.createDataFrame([(1, "a")], "id int, v string")
    h1 = snapshot(v1, None, "id", "check", now=T1)
    v2 = spark.createDataFrame([(1, "a", 5)], "id int, v string, w int")
    h2 = snapshot(v2, h1, "id", "check", now=T2)
    assert h2.count() == 2 and "w" in h2.columns


def test_new_record_deletes_not_repeated(spark):
    v1 = spark.createDataFrame([(1, "a", T1), (2, "b", T1)], SCH)
    h1 = snapshot(v1, None, "id", updated_at="updated_at", hard_deletes="new_record", now=T1)
    v2 = spark.createDataFrame([(1, "a", T1)], SCH)
    h2 = snapshot(v2, h1, "id", updated_at="updated_at", hard_deletes="new_record", now=T2).cache()
    dels = h2.filter("is_deleted = 'True'").collect()
    assert len(dels) == 1 and dels[0].id == 2 and dels[0].valid_to is None
    h3 = snapshot(v2, h2, "id", updated_at="updated_at", hard_deletes="new_record", now=T3)
    assert h3.count() == h2.count()  # the deletion record is not re-added


def test_null_keys_never_match(spark):
    v1 = spark.createDataFrame([(None, "a", T1)], SCH)
    h1 = snapshot(v1, None, "id", updated_at="updated_at", now=T1)
    h2 = snapshot(v1, h1, "id", updated_at="updated_at", now=T2)
    assert h2.count() == 2  # the NULL-key row is inserted again, as with '=' joins


def test_bad_options(spark):
    v1 = spark.createDataFrame([(1, "a", T1)], SCH)
    with pytest.raises(ValueError):
        snapshot(v1, None, "id", "timestamp")
    with pytest.raises(ValueError):
        snapshot(v1, None, "id", "bogus", updated_at="updated_at")


def test_custom_meta_column_names(spark):
    names = {"valid_from": "effective_from", "valid_to": "effective_to"}
    v1 = spark.createDataFrame([(1, "a", T1)], SCH)
    h1 = snapshot(v1, None, "id", updated_at="updated_at", now=T1, column_names=names)
    assert "effective_from" in h1.columns and "valid_from" not in h1.columns
    v2 = spark.createDataFrame([(1, "b", T2)], SCH)
    h2 = snapshot(v2, h1, "id", updated_at="updated_at", now=T2, column_names=names)
    assert h2.filter("effective_to is null").first().v == "b" and h2.count() == 2


def test_snapshot_table_split_layout_matches_single(spark):
    import uuid

    from starkiln.operators.snapshot import snapshot_table
    from starkiln.session import scratch_path

    root = scratch_path(spark, "test-snap-split", uuid.uuid4().hex)
    single, split = "t_snap_single_" + uuid.uuid4().hex[:6], "t_snap_split_" + uuid.uuid4().hex[:6]
    runs = [
        spark.createDataFrame([(1, "a", T1), (2, "b", T1), (3, "c", T1)], SCH),
        spark.createDataFrame([(1, "a", T1), (2, "B", T2), (4, "d", T2)], SCH),
        spark.createDataFrame([(1, "A", T3), (4, "d", T2)], SCH),
    ]
    for i, src in enumerate(runs):
        kw = dict(updated_at="updated_at", hard_deletes="invalidate", now=[T1, T2, T3][i])
        snapshot_table(spark, single, src, "id", root=root, **kw)
        r = snapshot_table(spark, split, src, "id", root=root, layout="split", **kw)
    assert sorted(map(tuple, spark.table(single).collect()), key=repr) == \
        sorted(map(tuple, spark.table(split).collect()), key=repr)
    assert spark.table(split + "__open").filter("valid_to is not null").count() == 0
    assert r["closed_this_run"] == 2  # id 1 changed, id 2 vanished
