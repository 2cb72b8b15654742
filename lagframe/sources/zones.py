"""Zone lookup by accent-insensitive name (C4) and point validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fold_accents


def zone_lookup(
    requests: DataFrame,
    zones: DataFrame,
    name_col: str = "name",
    zone_name_col: str = "zone_name",
    order_col: str = "zone_id",
    weight_col: str | None = None,
    on_missing: str = "frame",
) -> tuple[DataFrame, DataFrame]:
    """Match requested names to zones ignoring accents (C4).

    Several zones with the same folded name: the first by (`order_col`, name) wins
    -- a stated, deterministic order -- and `n_matches` reports how many there were
    so callers can warn. The zone dimension is first reduced to one row per folded
    name with a ``min_by`` aggregate (partial aggregation: a name shared by a third
    of all zones never lands whole in one task), then equi-joined on the folded key.
    With `weight_col`, each zone row stands for that many rows (a pre-aggregated
    dimension) and n_matches sums the weights.
    Returns (matches: request columns + first zone's columns + n_matches,
    not_found: requests without any zone). ``on_missing="error"`` raises instead when
    any request has no zone (like the original's single-name lookup; costs one
    ``limit(1)`` job).
    """
    r = requests.withColumn("_key", fold_accents(F.col(name_col)))
    zcols = [c for c in zones.columns if c != weight_col]
    z = zones.withColumn("_key", fold_accents(F.col(zone_name_col)))
    first = z.groupBy("_key").agg(
        F.min_by(F.struct(*[F.col(c) for c in zcols]), F.struct(F.col(order_col), F.col(zone_name_col))).alias("_z"),
        (F.sum(weight_col) if weight_col else F.count(F.lit(1))).cast("long").alias("n_matches"),
    )
    matches = r.join(first, "_key").select(*requests.columns, *[F.col(f"_z.{c}").alias(c) for c in zcols], "n_matches")
    missing = r.join(first.select("_key"), "_key", "left_anti").drop("_key")
    if on_missing == "error":
        absent = missing.limit(1).collect()
        if absent:
            raise ValueError(f"zone not found for {absent[0][name_col]!r}")
    elif on_missing != "frame":
        raise ValueError("on_missing must be 'frame' or 'error'")
    return matches, missing


def validate_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude", start: str | None = None, end: str | None = None) -> DataFrame:
    """Flag rows whose coordinates or date range are invalid (B17): adds `valid` and `reason`."""
    reasons = [
        F.when(F.col(lat).isNull() | ~F.col(lat).between(-90.0, 90.0), F.lit("latitude out of range")),
        F.when(F.col(lon).isNull() | ~F.col(lon).between(-180.0, 180.0), F.lit("longitude out of range")),
    ]
    if start and end:
        reasons.append(F.when(F.col(start) > F.col(end), F.lit("start after end")))
    reason = F.concat_ws("; ", *reasons)
    return df.withColumn("reason", F.when(reason != "", reason)).withColumn("valid", F.col("reason").isNull())
