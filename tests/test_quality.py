import pytest
from pyspark.sql import types as T

from starkiln.operators import quality as Q

SCH = "id int, b string, k int"


def test_basic_tests(spark):
    df = spark.createDataFrame([(1, "Queens", 1), (2, None, 1), (3, "Mars", 9), (3, "Mars", None)], SCH)
    assert Q.not_null(df, "b").count() == 1
    assert Q.not_null(df, "b", where="id > 2").count() == 0
    assert [tuple(r) for r in Q.unique(df, "id").collect()] == [(3, 2)]
    av = sorted(tuple(r) for r in Q.accepted_values(df, "b", ["Queens"]).collect())
    assert av == [("Mars", 2)]  # NULL passes
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    assert [r.from_field for r in Q.relationships(df, "k", parent, "pk").collect()] == [9]


def test_aggregated_tests(spark):
    df = spark.createDataFrame([(1, None, None), (1, "x", 2), (2, "x", 2)], SCH)
    nn = sorted(r.column_name for r in Q.aggregated_not_null(df, ["id", "b", "k"]).collect())
    assert nn == ["b", "k"]
    assert Q.aggregated_not_null(df, ["id", "b"], skip=["id", "b"]).count() == 0
    au = sorted(tuple(r) for r in Q.aggregated_unique(df, ["id", "b", "k"]).collect())
    assert au == [("b", "x", 2), ("id", "1", 2), ("k", "2", 2)]
    by_col = [tuple(r) for r in Q.verdict_by_column(Q.aggregated_not_null(df, ["b", "k"])).collect()]
    assert by_col == [("b", 1, True, True), ("k", 1, True, True)]


def test_verdict(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 1)], SCH)
    v = Q.verdict(Q.not_null(df, "b")).first()
    assert (v.failures, v.should_warn, v.should_error) == (2, True, True)
    v = Q.verdict(Q.not_null(df, "b"), warn_if="> 1", error_if="> 5").first()
    assert (v.should_warn, v.should_error) == (True, False)
    assert Q.verdict(Q.not_null(df, "b"), limit=1).first().failures == 1


def test_unit_diff_and_fixture(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("b", T.StringType())])
    exp = Q.fixture(spark, [{"id": 1}, {"id": 2, "b": "x"}], schema)
    assert exp.collect()[0].b is None
    with pytest.raises(ValueError):
        Q.fixture(spark, [{"nope": 1}], schema)
    assert Q.fixture(spark, [], schema).count() == 0
    act = spark.createDataFrame([(1, None), (2, "x")], "id int, b string")
    assert Q.unit_diff(act, exp).count() == 0
    act2 = spark.createDataFrame([(1, None), (2, "y"), (2, "y")], "id int, b string")
    got = sorted((r.b, r.actual_or_expected) for r in Q.unit_diff(act2, exp).collect())
    assert got == [("x", "expected"), ("y", "actual"), ("y", "actual")]


def test_contract(spark):
    df = spark.createDataFrame([(1, "a")], "id int, b string")
    out = Q.assert_contract(df, [("b", "string"), ("id", "int")])
    assert out.columns == ["b", "id"]
    with pytest.raises(ValueError):
        Q.assert_contract(df, [("id", "bigint"), ("b", "string")])
    with pytest.raises(ValueError):
        Q.assert_contract(df, [("id", "int")])
    with pytest.raises(ValueError):
        Q.assert_contract(df, [("id", None), ("b", "string")])
    warned = []
    Q.assert_contract(spark.range(1).selectExpr("cast(id as decimal(10,2)) as x"), [("x", "decimal")],
                      warn=warned.append)
    assert warned


def test_freshness_and_row_count(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "t string") \
        .selectExpr("cast(t as timestamp) as t")
    r = Q.freshness(df, "t", now="2024-01-02 01:00:00").first()
    assert r.age_seconds == 3600
    assert Q.assert_rows(df.filter("false"), 1).first().passed is False
    assert Q.assert_rows(df, 2).first().passed is True


def test_store_failures_and_custom_freshness(spark):
    df = spark.createDataFrame([(1, None, 1)], SCH)
    stored = Q.store_failures(Q.not_null(df, "b"), "t_failures_view", "view")
    assert Q.verdict(stored).first().failures == 1
    with pytest.raises(ValueError):
        Q.store_failures(df, "x", "materialized_view")
    q = spark.sql("select timestamp'2024-01-01 00:00:00' as m")
    r = Q.freshness_from(q, now="2024-01-02 00:00:00").first()
    assert str(r.max_loaded_at) == "2024-01-01 00:00:00"


def test_join_helpers_null_rules(spark):
    from starkiln.operators import joins as J

    left = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert sorted(r.v for r in J.semi(left, right, "k").collect()) == ["a"]
    assert sorted(r.v for r in J.anti(left, right, "k").collect()) == ["b", "n"]  # NULL key never matches
    assert sorted(r.v for r in J.semi(left, right, "k", null_safe=True).collect()) == ["a", "n"]
    got = sorted((r.v, r.w) for r in J.null_safe_join(left, right, "k").collect())
    assert got == [("a", "x"), ("n", "y")]
