"""Registered queries whose groups grow with the raw tables (one group, all rows distinct)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlation as C
from ..operators.asof import asof_backward
from ..operators.frames import describe
from ..operators.ranks import average_ranks
from ..operators.screening import zscore
from . import oracle as O
from . import views as V
from .catalog import dsql, register, rounded, rsql

_PAIR = "SELECT {group}CAST(l_extendedprice AS DOUBLE) AS x, CAST(l_quantity AS DOUBLE) AS y FROM lineitem"


def _lines(spark, d):
    return V.table(spark, d, "lineitem")


# ------------------------------------------------------------------ F5
@register(
    "rank_lines",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {O.avg_rank_sql('l_extendedprice', '1 = 1')} AS rank_price FROM lineitem",
)
def q_rank_lines(spark, d):
    """Average rank of every line's price among all lines: one group, nearly all distinct."""
    ranked = average_ranks(_lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), "l_extendedprice", [], "rank_price")
    return ranked


@register(
    "rank_lines_by_flag",
    "SELECT l_returnflag, l_quantity, count(*) AS n, min(r) AS rank_quantity FROM ("
    f"SELECT l_returnflag, l_quantity, {O.avg_rank_sql('l_quantity', 'l_returnflag')} AS r FROM lineitem) GROUP BY ALL",
)
def q_rank_lines_by_flag(spark, d):
    """Average rank of quantities per return flag: few values, each held by many rows."""
    ranked = average_ranks(_lines(spark, d).select("l_returnflag", "l_quantity"), "l_quantity", ["l_returnflag"], "r")
    return ranked.groupBy("l_returnflag", "l_quantity").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("rank_quantity"))


# ------------------------------------------------------------------ E2, E3, E4
@register(
    "corr_lines",
    O.build(
        "SELECT method, r, p_value, n FROM (" + O.methods_sql("st", ["one"]) + ")",
        extra=[("long", _PAIR.format(group="1 AS one, ")), ("st", O.pair_stats_sql("long", ["one"]))],
    ),
)
def q_corr_lines(spark, d):
    """Pearson and Spearman of price and quantity over all lines, one group of distinct pairs."""
    return rounded(C.correlate(_lines(spark, d), "l_extendedprice", "l_quantity"))


@register(
    "corr_lines_by_mode",
    O.build(
        O.methods_sql("st", ["l_returnflag", "l_linestatus"]),
        extra=[("long", _PAIR.format(group="l_returnflag, l_linestatus, ")), ("st", O.pair_stats_sql("long", ["l_returnflag", "l_linestatus"]))],
    ),
)
def q_corr_lines_by_mode(spark, d):
    return rounded(C.correlate(_lines(spark, d), "l_extendedprice", "l_quantity", ["l_returnflag", "l_linestatus"]))


@register(
    "corr_lines_pearson",
    O.build(
        O.methods_sql("st", ["l_returnflag"], ["pearson"]),
        extra=[("long", "SELECT l_returnflag, l_extendedprice + 1000000000.0 AS x, l_quantity * 0.001 + 1000000000.0 AS y FROM lineitem"), ("st", O.pair_stats_sql("(SELECT l_returnflag, x - 1000000000.0 AS x, y - 1000000000.0 AS y FROM long)", ["l_returnflag"]))],
    ),
)
def q_corr_lines_pearson(spark, d):
    """Pearson alone far from zero: merged co-moments, no window, no shuffle of the lines."""
    far = _lines(spark, d).select("l_returnflag", (F.col("l_extendedprice") + 1e9).alias("x"), (F.col("l_quantity") * 0.001 + 1e9).alias("y"))
    return rounded(C.correlate(far, "x", "y", ["l_returnflag"], methods=["pearson"]))


# ------------------------------------------------------------------ E21
_DESCRIBED = ["l_extendedprice", "l_quantity", "l_tax"]
_DESC = (
    "count(x) AS count, " + O.rnd("avg(x)", 4) + " AS mean, " + O.rnd("stddev_samp(x)", 4) + " AS std, " + O.rnd("min(x)", 4) + " AS min, "
    + ", ".join(f"{O.rnd(f'quantile_cont(x, {p})', 4)} AS {n}" for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    + ", " + O.rnd("max(x)", 4) + " AS max"
)


@register(
    "describe_lines",
    f"SELECT l_linestatus, variable, {_DESC} FROM (" + " UNION ALL ".join(f"SELECT l_linestatus, '{c}' AS variable, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in _DESCRIBED) + ") GROUP BY l_linestatus, variable",
)
def q_describe_lines(spark, d):
    """Exact quartiles of raw columns, two groups that grow with the table."""
    return rounded(describe(_lines(spark, d), _DESCRIBED, "l_linestatus"), default=4)


# ------------------------------------------------------------------ B14
@register(
    "zscore_lines",
    "SELECT l_orderkey, l_linenumber, l_partkey, " + O.rnd("(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER ()") + " AS z_l_extendedprice FROM lineitem",
)
def q_zscore_lines(spark, d):
    """Z-scores over all lines: moments are one aggregate, set beside the rows."""
    return rounded(zscore(_lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), ["l_extendedprice"]).drop("l_extendedprice"))


# ------------------------------------------------------------------ D6
@register(
    "asof_events",
    "SELECT c.event_id, c.user_id, strftime(c.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, v.value AS value_asof, strftime(v.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_asof FROM (SELECT * FROM events WHERE event_type = 'click') c "
    "ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL) v ON v.user_id = c.user_id AND c.ts >= v.ts",
)
def q_asof_events(spark, d):
    """What each user had viewed last at every click, at any time of day."""
    events = V.table(spark, d, "events")
    found = asof_backward(events.filter("event_type = 'click'").select("event_id", "user_id", "ts"), events.filter("event_type = 'view'"), "ts", ["value"], "user_id")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return found.select("event_id", "user_id", stamp("ts").alias("ts"), "value_asof", stamp("ts_asof").alias("ts_asof"))


@register(
    "asof_daily",
    O.build(f"SELECT region, {dsql('day')}, {rsql('ndvi')} FROM ndvi_daily", "ndvi_daily"),
)
def q_asof_daily(spark, d):
    """Daily requests: what the spine with forward fill gives."""
    from .catalog_misc import _ndvi

    seen = _ndvi(spark, d).filter(F.col("day").between(V.SPINE_START, V.SPINE_END))
    days = seen.select("region").distinct().withColumn("day", F.explode(F.sequence(F.lit(V.SPINE_START).cast("date"), F.lit(V.SPINE_END).cast("date"))))
    found = asof_backward(days, seen, "day", ["ndvi"], "region")
    return rounded(found.select("region", "day", F.col("ndvi_asof").alias("ndvi")))
