"""Property tests: the strategies against plain-Python statements of their semantics."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starkiln.operators import incremental as INC

SCHEMA = "k int, v int"
keys = st.one_of(st.none(), st.integers(0, 4))
rows_ = st.lists(st.tuples(keys, st.integers(0, 9)), max_size=8)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(target=rows_, delta=rows_)
def test_delete_insert_matches_definition(spark, target, delta):
    t = spark.createDataFrame(target, SCHEMA)
    d = spark.createDataFrame(delta, SCHEMA)
    dkeys = {k for k, _ in delta if k is not None}
    expected = Counter([r for r in target if r[0] is None or r[0] not in dkeys] + delta)
    assert as_counter(INC.apply_delete_insert(t, d, "k")) == expected


@SETTINGS
@given(target=rows_, delta=rows_)
def test_merge_matches_definition(spark, target, delta):
    nonnull = [k for k, _ in delta if k is not None]
    if len(nonnull) != len(set(nonnull)):
        return  # duplicate source keys are an error, tested elsewhere
    t = spark.createDataFrame(target, SCHEMA)
    d = spark.createDataFrame(delta, SCHEMA)
    src = {k: v for k, v in delta if k is not None}
    tkeys = {k for k, _ in target if k is not None}
    expected = [(k, src[k]) if k is not None and k in src else (k, v) for k, v in target]
    expected += [(k, v) for k, v in delta if k is None or k not in tkeys]
    assert as_counter(INC.apply_merge(t, d, "k")) == Counter(expected)


files = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
batches = st.lists(st.tuples(st.integers(0, 99), files, st.one_of(st.none(), st.integers(0, 3))), max_size=10)


@SETTINGS
@given(data=batches)
def test_latest_batch_matches_window_definition(spark, data):
    from pyspark.sql import functions as F

    from starkiln.operators.filters import latest_batch

    df = spark.createDataFrame(data, "id int, _source_file string, b int") \
        .withColumn("_loaded_at", F.timestamp_seconds(F.col("b"))).drop("b")
    mx = {}
    for _, f, b in data:
        if b is not None:
            mx[f] = max(mx.get(f, b), b)
    expected = Counter((i, f) for i, f, b in data if b is not None and b == mx.get(f))
    got = Counter((r.id, r._source_file) for r in latest_batch(df).collect())
    assert got == expected
