"""Small frame-level operators: date ranges, outbreak flags, descriptive summaries,
table coverage (C1, C5, B18, E21, A16)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from .groups import united
from .quantiles import exact_quantiles
from .rollup import YEAR, _keys


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows with `col` in the inclusive day range [start, end].

    Written as ``start <= col < end + 1 day`` on the raw column so it is pushed to
    the parquet scan (PushedFilters) and prunes row groups / partitions.
    """
    s = _dt.date.fromisoformat(str(start))
    e = _dt.date.fromisoformat(str(end)) + _dt.timedelta(days=1)
    if s >= e:
        raise ValueError(f"start ({start}) must be <= end ({end})")
    c = F.col(col)
    dt = df.schema[col].dataType.typeName()
    # literals from strings cast to the column's own type: no dependence on the Python
    # process's time zone (timestamp = day boundaries in the session zone); constant
    # folding keeps them pushable into the scan
    target = dt if dt in ("date", "timestamp_ntz", "timestamp") else "timestamp"
    suffix = "" if target == "date" else " 00:00:00"
    lo = F.lit(f"{s.isoformat()}{suffix}").cast(target)
    hi = F.lit(f"{e.isoformat()}{suffix}").cast(target)
    return df.filter((c >= lo) & (c < hi))


def outbreak_flag(df: DataFrame, col: str = "incidence", threshold: float = 100.0, name: str = "outbreak") -> DataFrame:
    """Flag rows above an incidence threshold (B18/C1); missing values (NULL, NaN) are not."""
    return df.withColumn(name, F.coalesce(nan_to_null(F.col(col).cast("double")) > threshold, F.lit(False)))


def describe(df: DataFrame, cols: Sequence[str], keys=None, exact: bool = True) -> DataFrame:
    """count/mean/std/min/quartiles/max per (keys, variable).

    ``exact=True`` finds the quartiles (linear interpolation, as pandas) by histogram
    refinement, for groups of any size, and runs its searches as jobs. ``exact=False``
    uses ``percentile_approx``, one pass whose memory does not grow with the group.
    """
    group = [*_keys(keys), "variable"]
    long = df.select(
        *_keys(keys),
        F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in cols])).alias("_kv"),
    ).select(*_keys(keys), "_kv.variable", "_kv.x")
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    rough = [] if exact else [F.percentile_approx("x", p, 10000).cast("double").alias(name) for name, p in quartiles.items()]
    out = long.groupBy(*group).agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"), *rough)
    if exact:
        out = united(out, exact_quantiles(long, "x", group, list(quartiles.values()), list(quartiles)), group)
    return out.select(*group, "count", "mean", "std", "min", *quartiles, "max")


def table_coverage(df: DataFrame, name: str, means: Mapping[str, str] | None = None) -> DataFrame:
    """Min/max year and row count of a weekly table, plus optional column means."""
    aggs = [F.min(YEAR).alias("min_year"), F.max(YEAR).alias("max_year"), F.count(F.lit(1)).alias("rows")]
    aggs += [F.avg(nan_to_null(F.col(c).cast("double"))).alias(a) for a, c in (means or {}).items()]
    return df.agg(*aggs).select(F.lit(name).alias("table_name"), "*")
