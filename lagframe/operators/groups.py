"""Joining what an aggregate found back to the rows of its groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def beside(d: DataFrame, a: DataFrame, group: Sequence[str], columns: Sequence[str | Column], extra: Column | None = None) -> DataFrame:
    """Rows of ``d`` with columns of their group's rows in ``a``; null is a group like others.

    The planner chooses the join by measured sizes and splits a large group. Without a group
    ``a`` must be small by its making (the row of a global aggregate): it is broadcast, on a
    key that is the same for all. ``extra``: a further condition on the joined columns.
    """
    of = [f"_of_{c}" for c in group]
    side = a.select(*[F.col(c).alias(o) for c, o in zip(group, of, strict=True)], *columns)
    if group:
        on = F.lit(True)
        for c, o in zip(group, of, strict=True):
            on = on & F.col(c).eqNullSafe(F.col(o))
    else:  # a key that the optimizer does not fold away, so that the join stays a hash join
        d = d.withColumn("_one", F.spark_partition_id() * 0)
        side = F.broadcast(side.withColumn("_only", F.spark_partition_id() * 0))
        on, of = F.col("_one") == F.col("_only"), ["_one", "_only"]
    return d.join(side, on if extra is None else on & extra).drop(*of)


def united(a: DataFrame, b: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group with the columns of both frames (one row per group each), null where a
    frame lacks the group."""
    mine = [c for c in a.columns if c not in group]
    theirs = [c for c in b.columns if c not in group]
    left = a.select(*group, *mine, *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in theirs])
    right = b.select(*group, *[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in mine], *theirs)
    return left.unionByName(right).groupBy(*group).agg(*[F.max(c).alias(c) for c in (*mine, *theirs)])
