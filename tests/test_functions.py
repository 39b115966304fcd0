import datetime as dt

import pytest
from pyspark.sql import functions as F

from starkiln.functions import dates as DT
from starkiln.functions import generators as G
from starkiln.functions import scalar as S
from starkiln.functions.aggregates import listagg


def one(spark, expr, schema="x timestamp_ntz, y timestamp_ntz", row=None):
    df = spark.createDataFrame([row], schema) if row is not None else spark.range(1)
    return df.select(expr.alias("r")).first()["r"]


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_seconds_count_boundaries(spark):
    r = one(spark, DT.seconds_between("x", "y"), row=(ts("2024-01-01 00:00:00.900"), ts("2024-01-01 00:00:01.100")))
    assert r == 1


@pytest.mark.parametrize("part,a,b,expected", [
    ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
    ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
    ("quarter", "2024-03-31 00:00:00", "2024-04-01 00:00:00", 1),
    ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
    ("hour", "2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
    ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
    ("week", "2024-01-07 00:00:00", "2024-01-08 00:00:00", 1),  # Sunday -> Monday crosses a week
    ("week", "2024-01-08 00:00:00", "2024-01-14 00:00:00", 0),
    ("year", "2024-01-01 00:00:00", "2023-12-31 00:00:00", -1),
])
def test_datediff_counts_boundaries(spark, part, a, b, expected):
    assert one(spark, DT.datediff(part, "x", "y"), row=(ts(a), ts(b))) == expected


def test_dateadd_clamps_month_end(spark):
    r = one(spark, DT.dateadd("month", 1, "x"), row=(ts("2024-01-31 10:00:00"), None))
    assert r == ts("2024-02-29 10:00:00")
    assert one(spark, DT.dateadd("quarter", 1, "x"), row=(ts("2024-11-30 00:00:00"), None)) == ts("2025-02-28 00:00:00")


def test_last_day_parts(spark):
    row = (ts("2024-05-15 08:00:00"), None)
    assert one(spark, DT.last_day("x", "month"), row=row) == dt.date(2024, 5, 31)
    assert one(spark, DT.last_day("x", "quarter"), row=row) == dt.date(2024, 6, 30)
    assert one(spark, DT.last_day("x", "year"), row=row) == dt.date(2024, 12, 31)
    assert one(spark, DT.last_day("x", "week"), row=row) == dt.date(2024, 5, 19)


def test_weekend_and_dayname(spark):
    sat, sun, mon = (ts("2024-01-06 12:00:00"), ts("2024-01-07 12:00:00"), ts("2024-01-08 12:00:00"))
    df = spark.createDataFrame([(sat,), (sun,), (mon,), (None,)], "x timestamp_ntz")
    got = [(r.w, r.d) for r in df.select(DT.is_weekend("x").alias("w"), DT.dayname("x").alias("d")).collect()]
    assert got == [(True, "Sat"), (True, "Sun"), (False, "Mon"), (False, None)]


def test_float_to_int_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (-1.5,), (1.4,), (None,)], "x double")
    assert [r.r for r in df.select(S.float_to_int("x").alias("r")).collect()] == [2, 3, -2, 1, None]


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a")], "v bigint, s string")
    keys = [r.k for r in df.select(S.surrogate_key("v", "s").alias("k")).collect()]
    assert keys[0] is not None and len(keys[0]) == 32 and keys[1] is None


def test_scd_hash_treats_null_as_empty(spark):
    df = spark.createDataFrame([(None, "a")], "v bigint, s string")
    r = df.select(S.scd_hash("v", "s").alias("h"), F.md5(F.lit("|a")).alias("e")).first()
    assert r.h == r.e


def test_code_maps_default_on_null(spark):
    df = spark.createDataFrame([(1,), (6,), (9,), (None,)], "c bigint")
    got = [(r.p, r.r) for r in df.select(S.payment_method("c").alias("p"), S.rate_type("c").alias("r")).collect()]
    assert got == [("Credit card", "Standard"), ("Voided trip", "Group ride"), ("Unmapped", "Unknown"),
                   ("Unmapped", "Unknown")]


def test_safe_divide_and_iff(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r.q for r in df.select(S.safe_divide("a", "b").alias("q")).collect()] == [None, 0.5]
    df2 = spark.createDataFrame([(None,), (1,)], "x int")
    assert [r.f for r in df2.select(S.iff(F.col("x") == 1, True, False).alias("f")).collect()] == [False, True]


def test_string_functions(spark):
    df = spark.createDataFrame([("a#b#cd",)], "s string")
    r = df.select(S.split_part("s", "#", -1).alias("last"), S.split_part("s", "#", 2).alias("second"),
                  S.right("s", 0).alias("r0"), S.right("s", 2).alias("r2"), S.position("#", "s").alias("p"),
                  S.position("z", "s").alias("p0"), S.replace("s", "#", "-").alias("rep"),
                  S.length("s").alias("n")).first()
    assert (r.last, r.second, r.r0, r.r2, r.p, r.p0, r.rep, r.n) == ("cd", "b", "", "cd", 2, 0, "a-b-cd", 6)


def test_casts(spark):
    df = spark.createDataFrame([("12",), ("x",)], "s string")
    assert [r.c for r in df.select(S.safe_cast("s", "int").alias("c")).collect()] == [12, None]
    with pytest.raises(Exception):
        df.select(S.cast("s", "int")).collect()
    b = spark.createDataFrame([(True,), (False,)], "b boolean").select(S.bool_to_text("b").alias("t")).collect()
    assert [r.t for r in b] == ["true", "false"]


def test_arrays(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    r = df.select(S.array_append(S.array_construct("a"), F.col("b")).alias("x"),
                  S.array_concat(S.array_construct("a"), S.array_construct("b", "a")).alias("y")).first()
    assert r.x == [1, 2] and r.y == [1, 2, 1]


def test_generate_series(spark):
    assert [r[0] for r in G.generate_series(spark, 5).collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        G.generate_series(spark, 0)


def test_date_spine(spark):
    days = [r[0] for r in G.date_spine(spark, "day", "2024-01-30", "2024-02-02").orderBy("date_day").collect()]
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert G.date_spine(spark, "day", "2024-01-01", "2024-01-01").count() == 0
    months = G.date_spine(spark, "month", "2024-01-31", "2024-04-01").orderBy("date_month").collect()
    assert [r[0] for r in months] == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]


def test_date_partitions(spark):
    got = [r[0] for r in G.date_partitions(spark, "2024-02-28,2024-03-01").orderBy("partition").collect()]
    assert got == ["20240228", "20240229", "20240301"]
    assert G.date_partitions(spark, "2024-02-28").count() == 1
    with pytest.raises(ValueError):
        G.date_partitions(spark, "2024-03-01,2024-02-28")
    with pytest.raises(ValueError):
        G.date_partitions(spark, "2024-13-01")


def test_listagg_ordered(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 1), ("g", "c", 3)], "g string, v string, o int")
    r = df.groupBy("g").agg(listagg("v", "|", order_by="o", descending=True).alias("l")).first()
    assert r.l == "c|b|a"


def test_listagg_limited_first_n(spark):
    from starkiln.operators.aggregate import listagg_limited

    df = spark.createDataFrame([("g", "a", 3), ("g", "b", 1), ("g", "c", 2), ("h", "z", 1)], "g string, v string, o int")
    got = {r.g: r.l for r in listagg_limited(df, ["g"], "v", ["o"], 2, "-", "l").collect()}
    assert got == {"g": "b-c", "h": "z"}


def test_surrogate_key_amount_out_of_range_is_null_not_error(spark):
    df = spark.createDataFrame([(1, 1e40), (1, 12.345)], "v bigint, a double")
    keys = [r.k for r in df.select(S.surrogate_key("v", ("a", "amount")).alias("k")).collect()]
    assert keys[0] is None and keys[1] is not None
    txt = df.select(S.canonical_text("a", "amount").alias("t")).collect()[1].t
    assert txt == "12.35"
