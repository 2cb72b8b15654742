"""Week calendars as native column expressions (no Python UDFs).

Two systems are supported:

* ``iso``  -- weeks start on Monday; week 1 holds the year's first Thursday (Jan 4).
* ``cdc``  -- MMWR weeks start on Sunday; week 1 is the first Sunday-week with at
  least four days in the new year (so it also holds Jan 4).

Every lag computation is done on an integer ``week index`` (weeks since the epoch
week start), so adding N weeks is integer addition and 53-week years need no
special casing. (year, week) is decoded only for output.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SYSTEMS = ("iso", "cdc")

# The epoch week starts used for the integer week index.
EPOCH_START = {"iso": _dt.date(1970, 1, 5), "cdc": _dt.date(1970, 1, 4)}  # a Monday, a Sunday


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check(system: str) -> None:
    if system not in SYSTEMS:
        raise ValueError(f"unknown week system {system!r}; use one of {SYSTEMS}")


def _days_since_start(d: Column, system: str) -> Column:
    """Days from the start of d's week to d (0..6). dayofweek: 1=Sunday .. 7=Saturday."""
    if system == "iso":
        return (F.dayofweek(d) + 5) % 7
    return F.dayofweek(d) - 1


def week_start_of(d, system: str = "iso") -> Column:
    """Start date (Monday for iso, Sunday for cdc) of the week holding date d."""
    _check(system)
    d = _col(d)
    return F.date_sub(d, _days_since_start(d, system))


def week1_start(year, system: str = "iso") -> Column:
    """Start date of week 1 of the given week-year: the week holding January 4."""
    _check(system)
    year = _col(year)
    jan4 = F.when(year.between(1, 9998), F.make_date(year, F.lit(1), F.lit(4)))
    return week_start_of(jan4, system)


def week_start(year, week, system: str = "iso") -> Column:
    """(year, week) -> start date of that week."""
    return F.date_add(week1_start(year, system), (_col(week) - 1) * 7)


def date_to_year(d, system: str = "iso") -> Column:
    _check(system)
    d = _col(d)
    if system == "iso":
        return F.extract(F.lit("YEAROFWEEK"), d)
    return F.year(F.date_add(week_start_of(d, "cdc"), 3))


def date_to_week(d, system: str = "iso") -> Column:
    _check(system)
    d = _col(d)
    if system == "iso":
        return F.weekofyear(d)
    start = week_start_of(d, "cdc")
    return (F.datediff(start, week1_start(F.year(F.date_add(start, 3)), "cdc")) / 7).cast("int") + 1


def week_index_of_date(d, system: str = "iso") -> Column:
    """Integer week index of the week holding d."""
    _check(system)
    start = week_start_of(_col(d), system)
    return (F.datediff(start, F.lit(EPOCH_START[system])) / 7).cast("int")


def week_index(year, week, system: str = "iso") -> Column:
    """(year, week) -> integer week index; consecutive weeks differ by exactly 1. NULL when
    (year, week) names no real week, rather than an index within the next year."""
    _check(system)
    idx = (F.datediff(week_start(year, week, system), F.lit(EPOCH_START[system])) / 7).cast("int")
    return F.when(is_valid_week(year, week, system), idx)


def index_start(idx, system: str = "iso") -> Column:
    _check(system)
    return F.date_add(F.lit(EPOCH_START[system]), _col(idx) * 7)


def index_to_year(idx, system: str = "iso") -> Column:
    return date_to_year(index_start(idx, system), system)


def index_to_week(idx, system: str = "iso") -> Column:
    return date_to_week(index_start(idx, system), system)


def week_add_year(year, week, n, system: str = "iso") -> Column:
    """Year part of (year, week) + n weeks (B3); n may be negative or a column."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return index_to_year(week_index(year, week, system) + n, system)


def week_add_week(year, week, n, system: str = "iso") -> Column:
    """Week part of (year, week) + n weeks."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return index_to_week(week_index(year, week, system) + n, system)


def is_valid_week(year, week, system: str = "iso") -> Column:
    """True when (year, week) names a real week: re-derive it from its start date.

    Week 53 of a 52-week year would silently roll into week 1; this flags it.
    """
    start = week_start(year, week, system)
    return (
        _col(week).between(1, 53)
        & (date_to_year(start, system) == _col(year))
        & (date_to_week(start, system) == _col(week))
    )


YEAR_BOUNDS = (2000, 2100)


def parse_yearweek(se, year_bounds: tuple[int, int] = YEAR_BOUNDS, strict: bool = False) -> tuple[Column, Column, Column]:
    """YYYYWW (int, double or string) -> (year, week, valid) (B1).

    valid is False when the value is not six digits (a double may end in .0), the year is outside
    `year_bounds` (default [2000, 2100]) or the week outside [1, 53]; year/week
    are NULL then (reject-split by default). ``strict=True`` fails the query on the
    first invalid value instead (``raise_error``), like the original's parser.
    """
    code = F.regexp_extract(_col(se).cast("string"), r"^\s*(\d{6})(?:\.0)?\s*$", 1)
    num = F.when(code != "", code).try_cast("bigint")
    digits = num.cast("string")
    year = (num / 100).cast("int")
    week = (num % 100).cast("int")
    valid = (
        num.isNotNull()
        & (F.length(digits) == 6)
        & year.between(*year_bounds)
        & week.between(1, 53)
    )
    valid = F.coalesce(valid, F.lit(False))
    if strict:
        bad = F.raise_error(F.concat(F.lit("invalid YYYYWW value: "), F.coalesce(_col(se).cast("string"), F.lit("NULL"))))
        return F.when(valid, year).otherwise(bad.cast("int")), F.when(valid, week), valid
    return F.when(valid, year), F.when(valid, week), valid
