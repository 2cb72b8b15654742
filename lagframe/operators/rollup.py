"""Daily -> weekly roll-up, pixel -> zone means, calendar spine with forward fill.

All operators take an ``keys`` list (entity columns: place, zone, point ...). With
no keys they behave like the single-series original.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.scalars import is_numeric, nan_to_null

YEAR, WEEK, VALID_DAYS = "year", "week", "valid_days"


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def weekly_rollup(
    daily: DataFrame,
    keys: Sequence[str] | str | None = None,
    date_col: str = "day",
    sum_cols: Sequence[str] | None = None,
    system: str = "iso",
    min_days: int | None = None,
) -> DataFrame:
    """Roll daily rows up to (keys, year, week).

    Column rule, taken from the schema: ``sum_cols`` (default: names ending in
    ``_sum``) are summed, with an all-NULL week giving 0.0; the date column is
    counted as ``valid_days``; every other numeric or boolean column is averaged (true is
    1); other columns are dropped. NaN is treated as missing. Decimal columns are summed
    exactly, so that equal weeks get bit-equal means in any order of their days.
    One shuffle on (keys, year, week), with map-side partial aggregation.
    """
    keys = _keys(keys)
    if date_col not in daily.columns:
        raise ValueError(f"daily frame needs a '{date_col}' column")
    fields = {f.name: f.dataType for f in daily.schema.fields}
    skip = set(keys) | {date_col, YEAR, WEEK}
    if sum_cols is None:
        sum_cols = [c for c in daily.columns if c.endswith("_sum") and c not in skip]
    day = F.col(date_col).cast("date")
    aggs = []
    for c, dt in fields.items():
        if c in skip or not (is_numeric(dt) or isinstance(dt, T.BooleanType)):
            continue
        if isinstance(dt, T.DecimalType):  # exact sums: the result does not depend on their order
            total, mean = F.sum(c).cast("double"), F.sum(c).cast("double") / F.count(c)
        else:
            v = nan_to_null(F.col(c).cast("double"))
            total, mean = F.sum(v), F.avg(v)
        aggs.append((F.coalesce(total, F.lit(0.0)) if c in sum_cols else mean).alias(c))
    aggs.append(F.count(day).cast("int").alias(VALID_DAYS))
    out = (
        daily.withColumn(YEAR, cal.date_to_year(day, system))
        .withColumn(WEEK, cal.date_to_week(day, system))
        .groupBy(*keys, YEAR, WEEK)
        .agg(*aggs)
    )
    if min_days is not None:
        out = out.filter(F.col(VALID_DAYS) >= min_days)
    return out


def zonal_mean(
    pixels: DataFrame,
    keys: Sequence[str] | str = ("zone", "band"),
    date_col: str = "image_date",
    value_col: str = "dn",
    weight_col: str | None = None,
    bbox: dict | None = None,
    out_col: str = "mean_dn",
) -> DataFrame:
    """Mean of a band over each zone per image date (A4); NULL means are dropped.

    Weighted mean sum(v*w)/sum(w) over pixels whose value is present (w = 1 by
    default). ``bbox`` = {"x": col, "y": col, "xmin":..,"xmax":..,"ymin":..,"ymax":..}
    filters the footprint before the aggregate (C6), so it is pushed to the scan.
    """
    keys = _keys(keys)
    df = pixels
    if bbox:
        df = df.filter(
            F.col(bbox["x"]).between(bbox["xmin"], bbox["xmax"]) & F.col(bbox["y"]).between(bbox["ymin"], bbox["ymax"])
        )
    v = nan_to_null(F.col(value_col).cast("double"))
    w = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    w = F.when(v.isNotNull(), w)
    out = df.groupBy(*keys, F.col(date_col).cast("date").alias(date_col)).agg(
        F.try_divide(F.sum(v * w), F.sum(w)).alias(out_col)
    )
    return out.filter(F.col(out_col).isNotNull())


def daily_spine_ffill(
    sparse: DataFrame,
    start,
    end,
    keys: Sequence[str] | str | None = None,
    date_col: str = "day",
    value_cols: Sequence[str] | None = None,
    zones: DataFrame | None = None,
    carry_cols: Sequence[str] = (),
    keep_outside: bool = False,
) -> DataFrame:
    """Sparse observations -> one row per (keys, day) in [start, end], forward-filled.

    Observations outside the range are never looked back on; days before the first
    observation stay NULL. The spine is generated per entity with
    ``explode(sequence(start, end))`` (no cross join); entities come from ``zones``
    (the zone dimension -- then `sparse` is read by this one join only) or from the
    distinct keys of ``sparse``. ``carry_cols`` ride along unfilled (e.g. a daily band
    outer-joined onto the spine, D4); ``keep_outside=True`` makes it a full outer join
    that also keeps observation rows outside the range (their filled columns NULL).
    The fill window is partitioned by the entity: bounded by the calendar length.
    """
    keys = _keys(keys)
    carry_cols = list(carry_cols)
    start_c, end_c = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    if value_cols is None:
        value_cols = [c for c in sparse.columns if c not in set(keys) | {date_col} | set(carry_cols)]
    obs = sparse.select(*keys, F.col(date_col).cast("date").alias(date_col), *value_cols, *carry_cols)
    if not keep_outside:
        obs = obs.filter(F.col(date_col).between(start_c, end_c))
    if keys:
        ents = (zones.select(*keys) if zones is not None else obs.select(*keys)).distinct()
        spine = ents.select(*keys, F.explode(F.sequence(start_c, end_c)).alias(date_col))
    else:
        spine = sparse.sparkSession.range(1).select(F.explode(F.sequence(start_c, end_c)).alias(date_col))
    spine = spine.withColumn("_in_range", F.lit(True))
    joined = spine.join(obs, [*keys, date_col], "full" if keep_outside else "left")
    inside = F.coalesce(F.col("_in_range"), F.lit(False))
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(date_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = [F.when(inside, F.last(F.when(inside, F.col(c)), ignorenulls=True).over(w)).alias(c) for c in value_cols]
    return joined.select(*keys, date_col, *filled, *carry_cols)


def daily_outer(left: DataFrame, right: DataFrame, keys: Sequence[str] | str | None = None, date_col: str = "day") -> DataFrame:
    """Full outer join of two daily series on (keys, day)."""
    return left.join(right, [*_keys(keys), date_col], "full")
