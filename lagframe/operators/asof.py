"""Backward as-of lookup for requests at any time (D6), without a calendar spine.

Requests and observations are united and dealt by range over (entity, time); the written ranges
fix the order. Within a range each request takes the last observation ahead of it; what an
entity's earlier ranges saw last is carried in as a row ahead of the range's own. No task sees
more than a range, however long an entity's history is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .rollup import _keys


def asof_backward(requests: DataFrame, observations: DataFrame, time_col: str, values: Sequence[str], keys=None, suffix: str = "_asof", tolerance=None) -> DataFrame:
    """Every request with the ``values`` of the latest observation of its entity at or before
    its time (columns with ``suffix``, and that observation's time ``{time_col}{suffix}``).

    Null where there is none, or, with a ``tolerance`` (an interval for times, a number for
    numbers), only an older one. Of observations at one time the largest (by their values, in
    order) counts. Observations without a time are left out; a request without one finds
    none. Requests may repeat. Runs the sorting as a job.
    """
    keys = _keys(keys)
    payload = F.struct(F.col(time_col).alias("_t"), *[F.col(v).alias(v) for v in values])
    seen = observations.filter(F.col(time_col).isNotNull()).select(*keys, F.col(time_col).alias("_t"), F.lit(0).alias("_kind"), payload.alias("_seen"))
    rows = requests.select(F.struct(*requests.columns).alias("_row"), *keys, F.col(time_col).alias("_t"))
    asked = rows.select(*keys, "_t", F.lit(1).alias("_kind"), F.lit(None).cast(seen.schema["_seen"].dataType).alias("_seen"), "_row", F.monotonically_increasing_id().alias("_place"))
    seen = seen.select(*keys, "_t", "_kind", "_seen", F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(0).cast("long").alias("_place"))
    order = [*keys, "_t", "_kind", "_seen", "_place"]
    ranged = seen.unionByName(asked).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = scratch_table(ranged.select(*keys, "_seen", "_row", "_at"), "asof").withColumn("_range", F.shiftright("_at", 33))
    last = ranged.groupBy(*keys, "_range").agg(F.max_by("_seen", F.when(F.col("_seen").isNotNull(), F.col("_at"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = last.select(*keys, F.last("_last", ignorenulls=True).over(earlier).alias("_seen"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(-1).cast("long").alias("_at"), "_range")
    within = Window.partitionBy(*keys, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    found = ranged.unionByName(ahead).withColumn("_found", F.last("_seen", ignorenulls=True).over(within)).filter(F.col("_row").isNotNull())
    near = F.col(f"_row.{time_col}").isNotNull()
    if tolerance is not None:
        near = near & (F.col("_found._t") >= F.col(f"_row.{time_col}") - tolerance)
    out = [F.when(near, F.col(f"_found.{v}")).alias(f"{v}{suffix}") for v in values]
    return found.select("_row.*", F.when(near, F.col("_found._t")).alias(f"{time_col}{suffix}"), *out)
