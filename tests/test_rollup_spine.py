import datetime as dt

import pytest
from pyspark.sql import functions as F

from lagframe.functions.scalars import fold_accents, scale_lst, scale_ndvi
from lagframe.operators.rollup import daily_outer, daily_spine_ffill, weekly_rollup, zonal_mean

from .conftest import rows

DAILY = "day date, wind double, gust_max double, snow_sum double, calm boolean"


def test_rollup_one_week(spark):
    monday = dt.date(2023, 3, 6)
    wind = [3.5, 1.25, 0.75, 6.0, 2.5, 4.0, 8.25]
    df = spark.createDataFrame([(monday + dt.timedelta(days=i), w, 2 * w, 0.125 * i, i < 2) for i, w in enumerate(wind)], DAILY)
    (r,) = weekly_rollup(df).collect()
    assert (r.year, r.week, r.valid_days) == (2023, 10, 7)
    assert (r.wind, r.gust_max, r.snow_sum) == (3.75, 7.5, 2.625)
    assert r.calm == pytest.approx(2 / 7)  # booleans are averaged


def test_rollup_two_iso_weeks_and_rules(spark):
    days = [dt.date(2020, 12, 30), dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.date(2021, 1, 4)]
    df = spark.createDataFrame([(d, 1.0 + i, None, None, None) for i, d in enumerate(days)], DAILY).withColumn("label", F.lit("x"))
    out = {(r.year, r.week): r for r in weekly_rollup(df).collect()}
    assert set(out) == {(2020, 53), (2021, 1)}
    assert out[(2020, 53)].snow_sum == 0.0  # an all-missing week sums to 0
    assert out[(2020, 53)].wind == 2.0 and out[(2021, 1)].wind == 4.0
    assert "label" not in weekly_rollup(df).columns  # text columns are dropped


def test_rollup_of_decimals_is_exact_in_any_order(spark):
    monday = dt.date(2023, 3, 6)
    values = ["0.100000000", "0.200000000", "0.300000000", "1000000.000000001", "0.700000000"]
    rows_ = [(p, monday + dt.timedelta(days=i), v) for p, vs in (("a", values), ("b", values[::-1])) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows_, "place string, day date, v string").withColumn("v", F.col("v").cast("decimal(20,9)"))
    got = {r.place: r.v for r in weekly_rollup(df, keys="place").collect()}
    assert got["a"] == got["b"] == 1000001.300000001 / 5


def test_rollup_nan_is_missing_and_keys(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), float("nan")), ("a", dt.date(2024, 1, 2), 4.0), ("b", dt.date(2024, 1, 1), 1.0)],
        "place string, day date, t double",
    )
    out = {r.place: r for r in weekly_rollup(df, keys=["place"]).collect()}
    assert out["a"].t == 4.0 and out["a"].valid_days == 2
    assert out["b"].t == 1.0


def test_rollup_requires_date(spark):
    with pytest.raises(ValueError):
        weekly_rollup(spark.createDataFrame([(1.0,)], "t double"))


def test_spine_forward_fill(spark):
    composites = [(dt.date(2022, 6, 3), 1234), (dt.date(2022, 6, 11), 4321), (dt.date(2022, 7, 1), 9999)]
    comp = spark.createDataFrame(composites, "day date, dn int").select("day", scale_ndvi("dn").alias("ndvi"))
    out = daily_spine_ffill(comp, "2022-06-01", "2022-06-20").orderBy("day").collect()
    assert [r.ndvi for r in out] == [None] * 2 + [pytest.approx(0.1234)] * 8 + [pytest.approx(0.4321)] * 10


def test_spine_leading_nulls_per_zone(spark):
    comp = spark.createDataFrame([("z1", dt.date(2024, 1, 3), 0.2), ("z2", dt.date(2024, 1, 1), 0.9)], "zone string, day date, v double")
    out = rows(daily_spine_ffill(comp, "2024-01-01", "2024-01-04", keys=["zone"]), "zone", "day", "v")
    assert [r[2] for r in out if r[0] == "z1"] == [None, None, 0.2, 0.2]
    assert [r[2] for r in out if r[0] == "z2"] == [0.9, 0.9, 0.9, 0.9]


def test_kelvin_dn_to_celsius(spark):
    df = spark.createDataFrame([(13657.5,), (0.0,), (None,)], "dn double")
    got = [r[0] for r in df.select(scale_lst("dn")).collect()]
    assert got == [pytest.approx(0.0), pytest.approx(-273.15), None]


def test_zonal_mean_footprint(spark):
    px = spark.createDataFrame([(x, y, float(10 * x + y)) for x in range(4) for y in range(4)], "x int, y int, dn double")
    px = px.withColumns({"zone": F.lit("z"), "band": F.lit("B"), "image_date": F.lit("2024-01-01").cast("date")})
    (r,) = zonal_mean(px, bbox={"x": "x", "y": "y", "xmin": 1, "xmax": 2, "ymin": 0, "ymax": 1}).collect()
    assert r.mean_dn == pytest.approx((10 + 11 + 20 + 21) / 4)


def test_zonal_mean_weights_and_nulls(spark):
    px = spark.createDataFrame(
        [("z", "B", dt.date(2024, 1, 1), 10.0, 1.0), ("z", "B", dt.date(2024, 1, 1), 20.0, 3.0), ("z", "B", dt.date(2024, 1, 1), None, 5.0), ("z", "B", dt.date(2024, 1, 2), None, 1.0)],
        "zone string, band string, image_date date, dn double, w double",
    )
    out = zonal_mean(px, weight_col="w").collect()
    assert len(out) == 1  # the all-NULL day is dropped
    assert out[0].mean_dn == pytest.approx(17.5)


def test_daily_outer(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 0.5)], "day date, ndvi double")
    b = spark.createDataFrame([(dt.date(2024, 1, 2), 20.0)], "day date, lst double")
    assert len(daily_outer(a, b).collect()) == 2


def test_fold_accents(spark):
    df = spark.createDataFrame([("Córdoba Açores Besançon Ñandú Ökonomie straße Ωά й",)], "t string")
    assert df.select(fold_accents("t")).first()[0] == "Cordoba Acores Besancon Nandu Okonomie straße Ωα и"


def test_fold_accents_of_other_scripts(spark):
    import unicodedata

    texts = ["שָׁלוֹם", "ваше҃", "क़ज़", "ガギ プ", "e\u20d7x", "a\u0301\u0323", "ǟ ṩ ệ", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [t and "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn") for t in texts]
    assert [r[0] for r in df.select(fold_accents("t")).collect()] == want


def test_spine_carry_zones_and_outside_rows(spark):
    obs = spark.createDataFrame(
        [("z1", dt.date(2024, 1, 2), 0.3, None), ("z1", dt.date(2024, 1, 3), None, 20.0), ("z1", dt.date(2024, 1, 9), 0.9, 25.0)],
        "zone string, day date, ndvi double, lst double",
    )
    zones = spark.createDataFrame([("z1",), ("z2",)], "zone string")
    out = daily_spine_ffill(obs, "2024-01-01", "2024-01-04", keys=["zone"], value_cols=["ndvi"], zones=zones, carry_cols=["lst"], keep_outside=True)
    got = rows(out, "zone", "day", "ndvi", "lst")
    z1 = [(r[1].day, r[2], r[3]) for r in got if r[0] == "z1"]
    assert z1 == [(1, None, None), (2, 0.3, None), (3, 0.3, 20.0), (4, 0.3, None), (9, None, 25.0)]
    assert [r[2] for r in got if r[0] == "z2"] == [None] * 4  # zone from the dimension, no observations
