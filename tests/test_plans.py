"""Plan regression tests: the physical-plan properties the library relies on at scale."""

import contextlib
import io

from pyspark.sql import functions as F

from starkiln.operators import incremental as INC
from starkiln.plans import registry as R
from starkiln.sources import driver_tables as D

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _raw_table(spark):
    import uuid

    from starkiln.operators import tables as TB
    from starkiln.session import scratch_path

    name = "t_plan_raw_" + uuid.uuid4().hex[:6]
    TB.write_version(D.raw_trips(spark, SF_SMALL), name, scratch_path(spark, "test-plans", uuid.uuid4().hex),
                     partition_by=["_source_file"])
    return spark.table(name)


def test_fact_lookups_are_broadcast_and_predicates_pushed(spark):
    from starkiln.plans import models as M

    p = plan(M.fct_trips(M.stg_trips(_raw_table(spark)), R.dim(spark, SF_SMALL)))
    assert p.count("BroadcastHashJoin") >= 2 and "LeftOuter" in p
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "GreaterThan(total_amount,0.0)" in p and "GreaterThan(trip_distance,0.0)" in p  # PushedFilters
    raw_schema = [line for line in p.splitlines() if line.startswith("ReadSchema") and "trip_distance" in line][0]
    assert "store_and_fwd_flag" not in raw_schema and "mta_tax" not in raw_schema  # pruned columns


def test_watermark_is_a_literal_pushed_to_the_scan(spark):
    from starkiln.operators import filters as FL
    from starkiln.plans import models as M

    raw = _raw_table(spark)
    target = raw.filter(F.col("_loaded_at") <= F.lit("2024-01-21").cast("timestamp"))
    assert "GreaterThan(_loaded_at," in plan(FL.since_watermark(M.stg_trips(raw), target))


def test_merge_has_no_full_outer_join(spark):
    t = D.table(spark, SF_SMALL, "orders")
    d = t.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    p = plan(INC.apply_merge(t, d, "o_orderkey"))
    assert "FullOuter" not in p and "BroadcastHashJoin" in p


def test_first_n_listagg_limits_before_the_shuffle(spark):
    p = plan(R.agg_09_limit(spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_no_python_on_row_paths(spark):
    for name in ("prj_04", "agg_01", "dq_06", "scd_01", "inc_03"):
        p = plan(R.REGISTRY[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
