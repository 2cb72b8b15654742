from lagframe.session import scratch_path
from lagframe.sources.landed import land_case_csv
from lagframe.sources.tables import Store
from lagframe.streaming.landed_stream import stream_case_files

SCHEMA = "geocode int, year int, se string, cases long, cases_est double, level int, incidence double"


def test_stream_ingest_is_incremental(spark):
    root = scratch_path(spark, "t-stream-landed")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    store = Store(spark, scratch_path(spark, "t-stream-store"), prefix="ts_")
    store.create_schema()
    first = spark.createDataFrame([(1, 2024, "202401", 3, 3.0, 1, 0.5), (2, 2024, "202402", 4, 4.0, 1, 0.6)], SCHEMA)
    land_case_csv(first, root + "/part1")
    assert stream_case_files(spark, root + "/part1", store, {"A": 1, "B": 2}, ckpt) == 2
    assert stream_case_files(spark, root + "/part1", store, {"A": 1, "B": 2}, ckpt) == 0  # nothing new
    assert store.table("cases_raw").count() == 2


def test_stream_picks_up_newly_landed_files(spark):
    root = scratch_path(spark, "t-stream-landed2")
    ckpt = scratch_path(spark, "t-stream-ckpt2")
    store = Store(spark, scratch_path(spark, "t-stream-store2"), prefix="ts2_")
    store.create_schema()
    land_case_csv(spark.createDataFrame([(1, 2024, "202401", 3, 3.0, 1, 0.5)], SCHEMA), root + "/g=a")
    assert stream_case_files(spark, root, store, {"A": 1}, ckpt) == 1
    land_case_csv(spark.createDataFrame([(1, 2024, "202405", 2, 2.0, 1, 0.4)], SCHEMA), root + "/g=b")
    assert stream_case_files(spark, root, store, {"A": 1}, ckpt) == 1
    assert sorted(r.week for r in store.table("cases_raw").collect()) == [1, 5]
