import datetime as dt

import pytest
from pyspark.sql import functions as F

from lagframe.functions import calendar as cal


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


@pytest.mark.parametrize(
    "se,expected",
    [(202401, (2024, 1)), ("202401", (2024, 1)), (202053, (2020, 53)), (202401.0, (2024, 1))],
)
def test_parse_yearweek_valid(spark, se, expected):
    y, w, ok = cal.parse_yearweek(F.lit(se))
    assert tuple(_one(spark, y, w, ok)) == (*expected, True)


@pytest.mark.parametrize("se", [20241, 199001, 202400, 202454, "abc", None])
def test_parse_yearweek_rejects(spark, se):
    y, w, ok = cal.parse_yearweek(F.lit(se))
    assert tuple(_one(spark, y, w, ok)) == (None, None, False)


def test_parse_yearweek_strict_raises(spark):
    y, w, ok = cal.parse_yearweek(F.lit(202454), strict=True)
    with pytest.raises(Exception, match="invalid YYYYWW"):
        _one(spark, y, w, ok)
    y, w, ok = cal.parse_yearweek(F.lit(202401), strict=True)
    assert tuple(_one(spark, y, w, ok)) == (2024, 1, True)


def test_parse_yearweek_custom_bounds(spark):
    y, w, ok = cal.parse_yearweek(F.lit(199001), year_bounds=(1990, 2100))
    assert tuple(_one(spark, y, w, ok)) == (1990, 1, True)


@pytest.mark.parametrize(
    "day,expected",
    [(dt.date(2024, 1, 1), (2024, 1)), (dt.date(2020, 12, 31), (2020, 53)), (dt.date(2021, 1, 3), (2020, 53))],
)
def test_iso_week_of_date(spark, day, expected):
    d = F.lit(day)
    assert tuple(_one(spark, cal.date_to_year(d), cal.date_to_week(d))) == expected


@pytest.mark.parametrize(
    "day,expected",
    [
        (dt.date(2021, 1, 3), (2021, 1)),  # a Sunday: first MMWR week of 2021
        (dt.date(2021, 1, 2), (2020, 53)),  # 2020 has 53 MMWR weeks
        (dt.date(2024, 1, 1), (2024, 1)),  # week of Sun 2023-12-31 holds Jan 4
        (dt.date(2015, 1, 3), (2014, 53)),
        (dt.date(2017, 1, 1), (2017, 1)),
    ],
)
def test_cdc_week_of_date(spark, day, expected):
    d = F.lit(day)
    assert tuple(_one(spark, cal.date_to_year(d, "cdc"), cal.date_to_week(d, "cdc"))) == expected


@pytest.mark.parametrize(
    "start,n,expected",
    [((2024, 1), 4, (2024, 5)), ((2024, 50), 4, (2025, 2)), ((2020, 50), 4, (2021, 1)), ((2024, 7), 0, (2024, 7)), ((2024, 5), -4, (2024, 1))],
)
def test_week_add(spark, start, n, expected):
    y, w = F.lit(start[0]), F.lit(start[1])
    assert tuple(_one(spark, cal.week_add_year(y, w, n), cal.week_add_week(y, w, n))) == expected


def test_week_add_is_additive_and_invertible(spark):
    base = spark.range(2015, 2026).select(F.col("id").cast("int").alias("y")).withColumn("w", F.explode(F.array(*[F.lit(i) for i in (1, 26, 52)])))
    pairs = [(a, b) for a in (-60, -3, 0, 5, 53) for b in (-7, 0, 4, 60)]
    df = base.withColumn("ab", F.explode(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in pairs])))
    a, b = F.col("ab")[0], F.col("ab")[1]
    y1, w1 = cal.week_add_year("y", "w", a), cal.week_add_week("y", "w", a)
    two_step = (cal.week_add_year(y1, w1, b), cal.week_add_week(y1, w1, b))
    one_step = (cal.week_add_year("y", "w", a + b), cal.week_add_week("y", "w", a + b))
    back = (cal.week_add_year(y1, w1, -a), cal.week_add_week(y1, w1, -a))
    bad = df.filter(
        (two_step[0] != one_step[0]) | (two_step[1] != one_step[1]) | (back[0] != F.col("y")) | (back[1] != F.col("w"))
    ).count()
    assert bad == 0


def test_week_start_and_validity(spark):
    r = _one(
        spark,
        cal.week_start(F.lit(2020), F.lit(53)),
        cal.week_start(F.lit(2021), F.lit(1), "cdc"),
        cal.is_valid_week(F.lit(2020), F.lit(53)),
        cal.is_valid_week(F.lit(2025), F.lit(53)),
    )
    assert tuple(r) == (dt.date(2020, 12, 28), dt.date(2021, 1, 3), True, False)


def test_unknown_system_raises():
    with pytest.raises(ValueError):
        cal.date_to_week(F.col("d"), "julian")
