"""Lagged joins of an outcome series with driver series.

Climate of week t lands on outcome week t + lag. The match is an equi-join on
(entity keys, integer week index), so 53-week years need no special casing and
Catalyst/AQE pick broadcast or sort-merge from runtime sizes. A row that names no real
week (week 53 of a 52-week year) has a NULL index: it matches nothing and explains nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.scalars import nan_to_null
from .rollup import VALID_DAYS, WEEK, YEAR, _keys

IDX = "_week_idx"


def _require(df: DataFrame, cols, what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} needs columns {missing}")


def with_week_index(df: DataFrame, system: str = "iso", name: str = IDX) -> DataFrame:
    return df.withColumn(name, cal.week_index(F.col(YEAR), F.col(WEEK), system))


def split_weeks(df: DataFrame, system: str = "iso") -> tuple[DataFrame, DataFrame]:
    """(rows that name a real week, rejects): week 53 of a 52-week year, or a NULL, is none."""
    ok = F.coalesce(cal.is_valid_week(F.col(YEAR), F.col(WEEK), system), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def lag_targets(climate: DataFrame, lag: int = 4, system: str = "iso") -> DataFrame:
    """Add the week each row explains: (year_target, week_target) = (year, week) + lag (D2);
    NULL for a row that names no real week."""
    _require(climate, [YEAR, WEEK], "lag_targets")
    idx = cal.week_index(F.col(YEAR), F.col(WEEK), system) + F.lit(lag)
    return climate.withColumns(
        {"year_target": cal.index_to_year(idx, system), "week_target": cal.index_to_week(idx, system)}
    )


def lagged_values(
    climate: DataFrame,
    lag: int,
    keys=None,
    value_cols: Sequence[str] | None = None,
    system: str = "iso",
) -> DataFrame:
    """Climate re-keyed on its target week with every value column suffixed `_lag{N}`."""
    keys = _keys(keys)
    _require(climate, [*keys, YEAR, WEEK], "climate frame")
    if value_cols is None:
        value_cols = [c for c in climate.columns if c not in set(keys) | {YEAR, WEEK, "year_target", "week_target"}]
    suffix = f"_lag{lag}"
    return climate.select(
        *keys,
        (cal.week_index(F.col(YEAR), F.col(WEEK), system) + F.lit(lag)).alias(IDX),
        *[F.col(c).alias(f"{c}{suffix}") for c in value_cols],
    )


def lag_join(
    cases: DataFrame,
    climate: DataFrame,
    lag: int = 4,
    keys=None,
    value_cols: Sequence[str] | None = None,
    system: str = "iso",
    empty_without_driver: bool = False,
) -> DataFrame:
    """Left join: every case row, with the climate of `lag` weeks earlier.

    Non-key climate columns get the suffix ``_lag{lag}``. Duplicate climate weeks fan
    out (as in the original); de-duplicate first with ``dedup_latest`` if needed.
    Entity keys join as keys and are never renamed. A climate frame without any row leaves
    the case rows with nulls; ``empty_without_driver`` looks (a job that stops at the first
    row) and then gives an empty frame, as the original does.
    """
    keys = _keys(keys)
    _require(cases, [*keys, YEAR, WEEK], "case frame")
    right = lagged_values(climate, lag, keys, value_cols, system)
    left = with_week_index(cases, system)
    joined = left.join(right, [*keys, IDX], "left").drop(IDX)
    return joined.limit(0) if empty_without_driver and climate.isEmpty() else joined


def feature_frame(frames: Sequence[DataFrame], keys=None, how: str = "inner") -> DataFrame:
    """Join several lagged frames on (keys, year, week) (D3)."""
    keys = [*_keys(keys), YEAR, WEEK]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, keys, how)
    return out


def join_coverage(joined: DataFrame, lag: int, keys=None) -> DataFrame:
    """Case rows and rows whose reference lag column is present.

    The reference column is the first ``*_lag{lag}`` column other than valid days.
    """
    suffix = f"_lag{lag}"
    lag_cols = [c for c in joined.columns if c.endswith(suffix) and c != f"{VALID_DAYS}{suffix}"]
    ref = F.lit(None)
    if lag_cols:
        ref = F.col(lag_cols[0])
        if joined.schema[lag_cols[0]].dataType.typeName() in ("float", "double"):
            ref = nan_to_null(ref)
    return joined.groupBy(*_keys(keys)).agg(
        F.count(F.lit(1)).alias("case_rows"),
        F.count(ref).alias("rows_with_data"),
        F.lit(lag_cols[0] if lag_cols else None).cast("string").alias("ref_column"),
    )
