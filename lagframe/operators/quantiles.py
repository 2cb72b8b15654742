"""Exact quantiles of groups of any size by histogram refinement.

An order statistic is searched between the least and the largest value of its group: rows are
counted per bin (map side), the bin that holds the place is kept with the least and the largest
value in it, and so on until it holds ``GATHER`` rows at most or one value; those rows are then
sorted. Bins are a monotone function of the value, so nothing is lost to rounding. A round reads
the rows once for all groups and quantiles and shuffles ``BINS`` counts per search at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .groups import beside

BINS = 1024
GATHER = 2048  # rows of a bin that are sorted at once
LARGEST = 1.7976931348623157e308  # of finite doubles


def _bin(x: Column) -> Column:
    """Bin of a value between ``_low`` and ``_high``: never falls as the value rises, and the two
    ends differ, so a search always gets narrower."""
    half = lambda v: F.least(F.greatest(v, F.lit(-LARGEST)), F.lit(LARGEST)) / 2
    width = half(F.col("_high")) - half(F.col("_low"))
    share = F.try_divide(half(x) - half(F.col("_low")), width)
    even = F.least(F.floor(share * BINS), F.lit(BINS - 1))
    return F.when(width > 0, even).otherwise(F.when(x == F.col("_low"), 0).otherwise(1)).cast("int")


def order_statistics(rows: DataFrame, value: str, group: Sequence[str], places) -> DataFrame:
    """``group``, ``place`` (from 0) and the ``found`` value at that place in each group's order.
    ``places``: column, an array of places, from the group's row count ``held``. Null and NaN
    values do not count."""
    group = list(group)
    x = F.col(value)
    rows = rows.select(*group, value).filter(x.isNotNull() & ~F.isnan(x))
    stats = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("held"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    search = stats.filter("held > 0").select(*group, F.explode(F.array_distinct(places)).alias("place"), F.lit(0).cast("long").alias("below"), "held", "_low", "_high")
    search = scratch_table(search, "quantile-search")
    open_ = (F.col("held") > GATHER) & (F.col("_low") < F.col("_high"))
    inside = x.between(F.col("_low"), F.col("_high"))
    spans = [*group, "_low", "_high"]
    while not search.filter(open_).isEmpty():
        wide = search.filter(open_).select(*spans).distinct()
        counted = beside(rows, wide, group, ["_low", "_high"], inside).groupBy(*spans, _bin(x).alias("_bin"))
        counted = counted.agg(F.count(F.lit(1)).alias("_held"), F.min(value).alias("_least"), F.max(value).alias("_most"))
        before = Window.partitionBy(*spans).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.coalesce(F.sum("_held").over(before), F.lit(0)))
        here = (F.col("place") >= F.col("below") + F.col("_before")) & (F.col("place") < F.col("below") + F.col("_before") + F.col("_held"))
        side = counted.select(*group, F.col("_low").alias("_from"), F.col("_high").alias("_to"), "_held", "_least", "_most", "_before")
        same = (F.col("_low") == F.col("_from")) & (F.col("_high") == F.col("_to")) & here
        found = beside(search.filter(open_), side, group, ["_from", "_to", "_held", "_least", "_most", "_before"], same)
        found = found.select(*group, "place", (F.col("below") + F.col("_before")).alias("below"), F.col("_held").alias("held"), F.col("_least").alias("_low"), F.col("_most").alias("_high"))
        search = scratch_table(search.filter(~open_).unionByName(found), "quantile-search")
    narrow = search.filter("_low < _high").select(*spans).distinct()
    sorted_ = beside(rows, narrow, group, ["_low", "_high"], inside).groupBy(*spans).agg(F.sort_array(F.collect_list(value)).alias("_rows"))
    sorted_ = sorted_.select(*group, F.col("_low").alias("_from"), F.col("_high").alias("_to"), "_rows")
    same = (F.col("_low") == F.col("_from")) & (F.col("_high") == F.col("_to"))
    met = beside(search.filter("_low < _high"), sorted_, group, ["_from", "_to", "_rows"], same)
    met = met.select(*group, "place", F.get("_rows", (F.col("place") - F.col("below")).cast("int")).alias("found"))
    return met.unionByName(search.filter("_low >= _high").select(*group, "place", F.col("_low").alias("found")))


def exact_quantiles(rows: DataFrame, value: str, group: Sequence[str], shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles of ``value`` per group with linear interpolation between neighbours (as
    pandas), one column per share; groups without a value are left out."""
    group = list(group)
    ends = [F.lit(float(s)) * (F.col("held") - 1) for s in shares]
    places = F.array(*[f(e).cast("long") for e in ends for f in (F.floor, F.ceil)])
    found = scratch_table(order_statistics(rows, value, group, places), "quantile-found")
    counts = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value))).groupBy(*group).agg(F.count(F.lit(1)).alias("held"))
    merged = found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("place", "found"))).alias("_at"))  # two entries a share at most
    both = beside(counts, merged, group, ["_at"])
    out = []
    for end, name in zip(ends, names, strict=True):
        low, high = F.col("_at")[F.floor(end).cast("long")], F.col("_at")[F.ceil(end).cast("long")]
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (end - F.floor(end))).alias(name))
    return both.select(*group, *out)
