"""Tables partitioned by year and bucketed by entity; case files with quoted line breaks."""

import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from lagframe.operators.lagjoin import lag_join
from lagframe.session import scratch_path
from lagframe.sources import landed as L
from lagframe.sources.tables import LOADED_AT, Store, co_located


def cases(spark, years, cases=1):
    rows = [(1 + p, f"p{p}", y * 100 + w, cases, 1.5, 1, 0.5) for y in years for w in range(1, 11) for p in range(6)]
    return spark.createDataFrame(rows, "geocode int, place string, se int, cases long, cases_est double, level int, incidence double")


def files(root):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def test_refresh_years_leaves_other_years_alone(spark):
    root = scratch_path(spark, "t-years")
    s = Store(spark, root, prefix="ty_", partition_by_year=True)
    s.create_schema()
    assert s.append_cases(cases(spark, [2020, 2021, 2022])) == 180
    before = files(f"{root}/cases_raw")
    assert s.refresh_years("cases_raw", cases(spark, [2021, 2023], cases=7)) == 120
    after = files(f"{root}/cases_raw")
    kept = {f: t for f, t in before.items() if "year=2021" not in f}
    assert kept and kept.items() <= after.items() and not {f for f in before if "year=2021" in f} & set(after)
    got = {(r.year, r.cases): r["count"] for r in s.table("cases_raw").groupBy("year", "cases").count().collect()}
    assert got == {(2020, 1): 60, (2021, 7): 60, (2022, 1): 60, (2023, 7): 60}
    out = io.StringIO()
    with redirect_stdout(out):
        s.table("cases_raw").filter("year = 2020").explain("formatted")
    assert "PartitionFilters: [isnotnull(year" in out.getvalue()
    whole = cases(spark, [2024]).withColumns({"year": F.lit(2024), "week": F.col("se") % 100})
    assert s.refresh("cases_raw", whole) == 60  # a full refresh still replaces all
    assert {r.year for r in s.table("cases_raw").select("year").distinct().collect()} == {2024}
    s.drop()
    plain = Store(spark, scratch_path(spark, "t-plain"), prefix="tp_")
    with pytest.raises(ValueError, match="not partitioned"):
        plain.refresh_years("cases_raw", cases(spark, [2020]))


def test_rows_inserted_by_sql_are_stamped(spark):
    s = Store(spark, scratch_path(spark, "t-default"), prefix="td_")
    s.create_schema()
    spark.sql("INSERT INTO td_weekly_satellite (place, year, week, ndvi) VALUES ('p', 2024, 1, 0.5)")
    s.append_satellite(spark.createDataFrame([("q", 2024, 2, 0.25)], "place string, year int, week int, ndvi double"))
    rows = s.table("weekly_satellite").collect()
    assert {(r.place, r.week, r.ndvi, r.valid_days) for r in rows} == {("p", 1, 0.5, None), ("q", 2, 0.25, None)}
    assert all(r[LOADED_AT] is not None for r in rows)
    s.drop()


def test_lag_join_without_driver_rows(spark):
    c = spark.createDataFrame([(2024, 5, 1.0)], "year int, week int, incidence double")
    k = spark.createDataFrame([], "year int, week int, rain double")
    assert lag_join(c, k, 4).collect() == [(2024, 5, 1.0, None)]
    none = lag_join(c, k, 4, empty_without_driver=True)
    assert none.count() == 0 and none.columns == ["year", "week", "incidence", "rain_lag4"]


@pytest.mark.parametrize("by_year", [False, True])
def test_lag_join_of_bucketed_tables_has_no_exchange(spark, by_year):
    s = Store(spark, scratch_path(spark, "t-buckets"), prefix=f"tb{int(by_year)}_", buckets=4, partition_by_year=by_year)
    s.create_schema()
    s.append_cases(cases(spark, [2020, 2021]))
    sat = cases(spark, [2020, 2021]).select("place", F.floor(F.col("se") / 100).cast("int").alias("year"), (F.col("se") % 100).alias("week"), F.lit(0.5).alias("ndvi"))
    s.append_satellite(sat)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the tables of a test are small
    try:
        with co_located(spark):
            joined = lag_join(s.table("cases_raw").drop(LOADED_AT), s.table("weekly_satellite").drop(LOADED_AT), 4, "place")
            out = io.StringIO()
            with redirect_stdout(out):
                joined.explain("formatted")
            found = joined.filter("ndvi_lag4 is not null").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "SortMergeJoin" in out.getvalue() and "Exchange" not in out.getvalue()
    assert found == 72  # weeks 5 to 10 of both years
    s.drop()


def land(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def test_case_files_with_quoted_line_breaks(spark, monkeypatch):
    root = scratch_path(spark, "t-breaks")
    head = "note,se,cases,cases_est,level,incidence\n"
    land(root, "geocode=1/year=2024/a.csv", head + '"one\ntwo, ""three""\n\nfour",202401,3,3.5,1,0.7\r\nplain,202402,4,,,\n"broken\nrecord",202403\n"x\ny",2024x4,1,1,1,1\n')
    land(root, "geocode=1/year=2024/b.csv", '\n  \n"se" , cases,cases_est,level,incidence\n202405,5,5.0,1,0.5\n')
    land(root, "geocode=2/year=2024/c.csv", "")
    land(root, "geocode=2/year=2024/d.csv", head)
    land(root, "geocode=2/year=2024/e.csv", head.encode() + "é,202406,6,6.0,2,0.6\n".encode() + b"\xff\xfe,202407,7,7.0,2,0.7\n")
    land(root, "geocode=3/year=2024/f.csv", head + "far,202408,1,1,1,1\n")
    big = "".join(f'"note {i}\nof {i}",2024{1 + i % 52:02d},{i},1.0,1,0.1\n' for i in range(3000))
    land(root, "geocode=4/year=2024/g.csv", head + big)
    monkeypatch.setattr(L, "BLOCK", 4096)
    rows, rejects = L.ingest_case_csv(spark, root, {"A": 1, "B": 2, "D": 4}, 2024, 2024)
    got = rows.filter("geocode < 4").collect()
    assert sorted((r.place, r.se, r.cases) for r in got) == [("A", 202401, 3), ("A", 202402, 4), ("A", 202405, 5), ("B", 202406, 6), ("B", 202407, 7)]
    assert sorted(r[L.CORRUPT] for r in rejects.collect()) == ['"broken\nrecord",202403', '"x\ny",2024x4,1,1,1,1']
    assert rows.filter("geocode = 4").agg(F.count("se"), F.sum("cases")).first() == (3000, 3000 * 2999 // 2)


def test_case_files_are_scanned_once_without_a_shuffle(spark):
    root = scratch_path(spark, "t-scan")
    land(root, "geocode=1/year=2024/a.csv", "se,cases,cases_est,level,incidence\n202401,3,3.5,1,0.7\n")
    rows, _ = L.ingest_case_csv(spark, root, {"A": 1}, 2024, 2024)
    out = io.StringIO()
    with redirect_stdout(out):
        rows.explain("formatted")
    assert out.getvalue().count("Scan binaryFile") <= 2 and "(1) Scan binaryFile" in out.getvalue()  # listed in the tree and in the details
    assert "Exchange hashpartitioning" not in out.getvalue()
