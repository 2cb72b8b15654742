"""Bad and odd input: CSV headers, NaN, failed appends, changed sources, session rules."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from lagframe.functions.calendar import parse_yearweek
from lagframe.operators import forecast as FC
from lagframe.operators import lagjoin as LJ
from lagframe.operators.frames import describe, outbreak_flag, table_coverage
from lagframe.plans import views as V
from lagframe.session import ensure_checkpoint_dir, scratch_path
from lagframe.sources import landed as L
from lagframe.sources.tables import Store, dedup_latest
from lagframe.streaming.landed_stream import stream_case_files

from .conftest import SF

NAN = float("nan")


def land(root, files):
    for name, text in files.items():
        path = os.path.join(root.replace("file:", ""), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


FILES = {
    "geocode=1/year=2024/a.csv": "se,cases,cases_est,level,incidence\n202401,3,3.5,1,0.7\n202402,x,1.0,1,0.1\n2024x3,1,1.0,1,0.1\n",
    "geocode=1/year=2024/b.csv": "\ufeffincidence,level,cases_est,cases,se\n0.25,2,9.5,9,202405\n\n0.5,2,1\n",
    "geocode=2/year=2024/c.csv": 'note,se,cases,cases_est,level,incidence\n"a, b",202406,4,4.5,1,0.5\nplain,202407,,,,\n',
    "geocode=2/year=2024/d.csv": "se,cases\n202408,1\n",
}


def test_csv_columns_by_name_and_no_line_lost(spark):
    root = scratch_path(spark, "t-names")
    land(root, FILES)
    rows, rejects = L.ingest_case_csv(spark, root, {"A": 1, "B": 2}, 2024, 2024)
    got = {r.se: (r.place, r.week, r.cases, r.cases_est, r.level, r.incidence) for r in rows.collect()}
    assert got == {
        202401: ("A", 1, 3, 3.5, 1, 0.7),
        202405: ("A", 5, 9, 9.5, 2, 0.25),
        202406: ("B", 6, 4, 4.5, 1, 0.5),
        202407: ("B", 7, None, None, None, None),
    }
    wrong = {r[L.CORRUPT] for r in rejects.collect()}
    assert wrong == {"202402,x,1.0,1,0.1", "2024x3,1,1.0,1,0.1", "0.5,2,1", "se,cases", "202408,1"}
    assert rows.count() == 4 and rejects.count() == 5  # all data lines


def test_csv_absent_root_is_empty(spark):
    rows, rejects = L.ingest_case_csv(spark, scratch_path(spark, "t-none"), {"A": 1}, 2024, 2025)
    assert rows.count() == rejects.count() == 0 and "incidence" in rows.columns


def test_stream_keeps_rejects(spark):
    root, ckpt, bad = (scratch_path(spark, f"t-sr-{x}") for x in ("landed", "ckpt", "bad"))
    store = Store(spark, scratch_path(spark, "t-sr-store"), prefix="tsr_")
    store.create_schema()
    land(root, FILES)
    assert stream_case_files(spark, root, store, {"A": 1, "B": 2}, ckpt, rejects=bad) == 4
    assert spark.read.parquet(bad).count() == 5
    store.drop()


def test_week_codes(spark):
    codes = ["202401", " 202453 ", "202401.7", "2.02401e5", "202400", "20241", None, "", "abc"]
    df = spark.createDataFrame([(c,) for c in codes], "se string")
    assert [r[0] for r in df.select(parse_yearweek(F.col("se"))[2]).collect()] == [True, True] + [False] * 7
    nums = spark.createDataFrame([(202401.0,), (202401.7,), (NAN,)], "se double")
    assert [r[0] for r in nums.select(parse_yearweek(F.col("se"))[2]).collect()] == [True, False, False]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, NAN), (2024, 3, 3.0), (2024, 4, 200.0)], "year int, week int, y double")
    assert [r.outbreak for r in outbreak_flag(df, "y", 100.0).orderBy("week").collect()] == [False, False, False, True]
    d = describe(df, ["y"]).first()
    assert d["count"] == 3 and d["mean"] == 68.0 and d["max"] == 200.0 and not math.isnan(d["std"])
    assert table_coverage(df, "t", {"m": "y"}).first().m == 68.0
    base = {r.week: r.pred_baseline for r in FC.baseline_forecast(df, "y", 3).collect()}
    assert base == {1: None, 2: 1.0, 3: 1.0, 4: 2.0}
    joined = LJ.lag_join(df.select("year", "week", "y"), df.withColumnRenamed("y", "t"), lag=0)
    assert LJ.join_coverage(joined, 0).first().rows_with_data == 3
    preds = spark.createDataFrame([(1.0, 2.0), (NAN, 5.0), (3.0, None), (4.0, 4.0)], "real double, p double")
    m = FC.forecast_metrics(preds, {"m": "p"}).first()
    assert (m.n, m.mae) == (2, 0.5)


CASES = "geocode int, place string, se int, cases long, cases_est double, level int, incidence double"


def test_appends_fail_whole_and_stamp(spark):
    s = Store(spark, scratch_path(spark, "t-append"), prefix="tap_", climate_vars=("wind", "soil"))
    s.create_schema()
    good = [(1, "a", 202401, 1, 1.0, 1, 0.5)] * 3
    with pytest.raises(ValueError, match="NOT NULL column place"):
        s.append_cases(spark.createDataFrame([*good, (1, None, 202401, 1, 1.0, 1, 0.5)], CASES))
    with pytest.raises(ValueError, match="invalid se"):
        s.append_cases(spark.createDataFrame([*good, (1, "a", 202499, 1, 1.0, 1, 0.5)], CASES))
    assert s.table("cases_raw").count() == 0
    assert s.append_cases(spark.createDataFrame(good, CASES)) == 3
    stamps = [r.loaded_at for r in s.table("cases_raw").collect()]
    assert len(set(stamps)) == 1 and abs((dt.datetime.now() - stamps[0]).total_seconds()) < 26 * 3600
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), 2.5)], "day date, wind double")
    assert s.append_daily(daily, 1.0, 2.0) == 1
    assert [(r.wind, r.soil, r.latitude) for r in s.table("daily_climate").collect()] == [(2.5, None, 1.0)]
    s.drop()
    assert not spark.catalog.tableExists("tap_cases_raw")


def test_an_append_reads_its_input_once(spark):
    s = Store(spark, scratch_path(spark, "t-once"), prefix="ton_")
    s.create_schema()
    seen = spark.sparkContext.accumulator(0)

    def look(rows):
        for r in rows:
            seen.add(1)
            yield r

    df = spark.createDataFrame(spark.createDataFrame([(1, "a", 202401 + i, 1, 1.0, 1, 0.5) for i in range(5)], CASES).rdd.mapPartitions(look), CASES)
    assert s.append_cases(df) == 5 and seen.value == 5
    s.drop()


def test_dedup_ties_do_not_depend_on_order(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("k", i, at) for i in range(20)]
    schema = "key string, v int, loaded_at timestamp"
    kept = {dedup_latest(spark.createDataFrame(r, schema).repartition(n), ["key"]).first().v for r, n in ((rows, 1), (rows[::-1], 1), (rows, 7))}
    assert len(kept) == 1


def test_changed_sources_are_read_anew(spark):
    at = scratch_path(spark, "t-source").replace("file:", "")
    for name in ("orders", "customer", "nation", "region", "lineitem", "supplier"):
        spark.read.parquet(f"{SF}/{name}.parquet").coalesce(1).write.parquet(f"{at}/{name}.parquet")
    first = V.cases_t(spark, at).agg(F.sum("cases")).first()[0]
    spark.read.parquet(f"{SF}/orders.parquet").coalesce(1).write.mode("append").parquet(f"{at}/orders.parquet")
    assert V.cases_t(spark, at).agg(F.sum("cases")).first()[0] == 2 * first
    assert V.table(spark, at, "orders").count() == 2 * V.table(spark, SF, "orders").count()


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
