"""Plan-shape checks for the scale properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from lagframe.operators import correlation as C
from lagframe.operators.frames import date_range
from lagframe.sources.tables import dedup_latest

from .conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_a_partial_aggregate_not_a_window(spark):
    df = spark.createDataFrame([("k", 1, dt.datetime(2024, 1, 1)), ("k", 2, dt.datetime(2024, 2, 1))], "key string, v int, loaded_at timestamp")
    plan = _plan(dedup_latest(df, ["key"]))
    assert "Window" not in plan
    assert "partial_max_by" in plan


def test_sweep_collapses_pairs_before_the_first_shuffle(spark):
    rows = [("a", float(i % 7), float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    plan = _plan(C.pair_stats(df, "x", "y", ["g"]))
    # a partial count keyed by the pair sits below the first exchange
    first_exchange = plan.rfind("Exchange hashpartitioning")
    assert "partial_count" in plan[first_exchange:]
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_date_range_reaches_the_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _plan(date_range(li, "l_shipdate", "1996-01-01", "1996-12-31").select(F.sum("l_extendedprice")))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
