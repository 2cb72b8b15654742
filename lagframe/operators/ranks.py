"""Exact ranks over groups of any size (F5), without a window over a whole group.

Equal values are counted first (map side), so that a tie is one row and never crosses a border.
The rows (group, value, count) are dealt by range over group and value and written, which fixes
the ranges; each (group, range) then adds up what the group holds in earlier ranges and, in a
window over that one range, what lies before the value. No task sees more than a range, however
large a group or however often a value occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..session import scratch_table

UPTO, TIES = "_upto", "_ties"


def counted_values(df: DataFrame, value: str, group: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct non-null values per group, with ``_ties`` (rows, or summed weights, that hold the
    value) and ``_upto`` (those of the group up to and with it), exact for groups of any size."""
    group = list(group)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    held = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(count.cast("long").alias(TIES))
    dealt = held.repartitionByRange(*[F.col(c) for c in (*group, value)]).sortWithinPartitions(*group, value)
    ranged = scratch_table(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    sums = ranged.groupBy(*group, "_range").agg(F.sum(TIES).alias("_held"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # what earlier ranges hold, as a row ahead of the range's own
    ahead = sums.select(
        *group, F.lit(None).cast(df.schema[value].dataType).alias(value), F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias(TIES),
        F.lit(-1).cast("long").alias("_at"), "_range",
    )
    running = Window.partitionBy(*group, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    counted = ranged.unionByName(ahead).withColumn(UPTO, F.sum(TIES).over(running))
    return counted.filter(F.col(value).isNotNull()).select(*group, value, TIES, UPTO)


def mean_place() -> Column:
    """Average rank of a counted value: the mean of the places that its ties take."""
    return F.col(UPTO) - (F.col(TIES) - 1) / F.lit(2.0)


def average_ranks(df: DataFrame, value: str, group: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """``df`` with the average rank (ties share the mean of their places) of ``value`` within
    ``group`` as ``name``; null where the value is null or NaN. Runs the counting as a job."""
    group = list(group)
    keyed = df.withColumn("_value", nan_to_null(F.col(value).cast("double")))
    ranks = scratch_table(counted_values(keyed.select(*group, "_value"), "_value", group).select(*group, "_value", mean_place().alias(name)), "ranks")
    ranks = ranks.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_value").alias("_of_value"), name)
    on = F.col("_value") == F.col("_of_value")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return keyed.join(ranks, on, "left").select(*df.columns, name)
