"""Pearson / Spearman correlations with p-values, and the lag sweep.

Design (one job for any number of variables x lags x methods):

1. the outcome side is exploded over the lags (one narrow row per case x lag,
   keyed by the climate week it needs: ``idx - lag``);
2. one LEFT equi-join per source with the wide weekly climate on (keys, week index)
   -- every case row survives, as in the original left merge;
3. unpivot the variables, flag the pairs where both values are present;
4. Pearson alone: co-moments that merge (``_moments_merged``), no window;
5. Spearman in a sweep: a group (keys, [source], variable, lag) holds one row per case week
   of one entity, so the calendar bounds it, and windows over its distinct pairs give the
   average ranks (``_moments_collapsed``);
6. Spearman over any frame (``correlate``): ranks by range and prefix sums
   (``_moments_ranged``), for groups of any size;
7. r and p-value as native expressions, methods emitted with ``inline``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.pvalue import with_pvalue
from ..functions.scalars import nan_to_null
from ..session import scratch_table
from .groups import beside, united
from .ranks import counted_values, mean_place
from .rollup import WEEK, YEAR, _keys

METHODS = ("pearson", "spearman")
MIN_PAIRS = 3
SWEEP_COLUMNS = ("variable", "method", "lag", "r", "p_value", "n")


def check_methods(methods: Iterable[str]) -> tuple[str, ...]:
    methods = tuple(methods)
    for m in methods:
        if m not in METHODS:
            raise ValueError(f"invalid method {m!r}; use one of {METHODS}")
    return methods


def guarded_r(cov: Column, sx: Column, sy: Column, n: Column, minx, maxx, miny, maxy, min_n: int = MIN_PAIRS) -> Column:
    """r = cov / (sx * sy), NULL when n < min_n, either side is constant or the moments
    are not finite."""
    ok = (n >= min_n) & (minx < maxx) & (miny < maxy)
    return F.when(ok, clamped_r(F.try_divide(cov, sx * sy)))


def clamped_r(r: Column) -> Column:
    """r within [-1, 1]; NaN and infinities, which least() would turn into 1, are undefined."""
    return F.when(F.abs(r) < F.lit(float("inf")), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def avg_rank(value: str, group: Sequence[str], valid: Column | None = None) -> Column:
    """Average rank (ties share the mean of their positions) within `group`.

    Rows where `valid` is false are sorted after the valid ones and get NULL; NaN counts
    as missing.
    """
    key = nan_to_null(F.col(value).cast("double"))
    flag = valid if valid is not None else key.isNotNull()
    part = Window.partitionBy(*group)
    asc = part.orderBy(flag.desc(), key.asc())
    desc = part.orderBy(flag.desc(), key.desc())
    n_valid = F.sum(flag.cast("long")).over(part)
    r = (F.rank().over(asc) + n_valid + 1 - F.rank().over(desc)).cast("double") / 2.0
    return F.when(flag, r)


RANK_STRATEGIES = ("collapsed", "ranged", "window")
GUARDS = ("_minx", "_maxx", "_miny", "_maxy")


def _guards() -> list[Column]:
    return [F.min("_x").alias("_minx"), F.max("_x").alias("_maxx"), F.min("_y").alias("_miny"), F.max("_y").alias("_maxy")]


def _moments_merged(d: DataFrame, group: list[str]) -> DataFrame:
    """Per-group pair count, guards and co-moments without a window: partial aggregates of
    (n, means, co-moments) merge, so a group of any size is spread over all tasks.

    Two passes over the rows: counts, extremes and means, then co-moments of the distances
    from those means, which keep their digits however far from zero the values lie."""
    pairs = d.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    a = d.groupBy(*group).agg(F.count("_x").alias("n"), *_guards(), F.avg("_x").alias("_px"), F.avg("_y").alias("_py"))
    far = beside(pairs, a, group, ["_px", "_py"]).withColumns({"_dx": F.col("_x") - F.col("_px"), "_dy": F.col("_y") - F.col("_py")})
    m = far.groupBy(*group).agg(F.covar_pop("_dx", "_dy").alias("_cxy"), F.stddev_pop("_dx").alias("_sx"), F.stddev_pop("_dy").alias("_sy"))
    return united(a.select(*group, "n", *GUARDS), m, group)


def _moments_ranged(d: DataFrame, group: list[str]) -> DataFrame:
    """As ``_moments_merged`` with co-moments of the average ranks, for groups of any size: equal
    pairs are counted map-side, each side's values are ranked by range (``ranks.counted_values``)
    and joined back, and the rank moments merge around the mean rank (n + 1) / 2."""
    pairs = d.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull()).groupBy(*group, "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    pairs = scratch_table(pairs, "pairs")
    a = scratch_table(d.groupBy(*group).agg(F.count("_x").alias("n"), *_guards(), F.avg("_x").alias("_px"), F.avg("_y").alias("_py")), "pair-counts")
    q = pairs
    for v, name in (("_x", "_rx"), ("_y", "_ry")):
        of = [f"_of_{c}" for c in (*group, v)]
        ranks = counted_values(pairs, v, group, "_c").select(*[F.col(c).alias(o) for c, o in zip((*group, v), of, strict=True)], mean_place().alias(name))
        on = F.col(v) == F.col(of[-1])
        for c, o in zip(group, of, strict=False):
            on = on & F.col(c).eqNullSafe(F.col(o))
        q = q.join(scratch_table(ranks, "pair-ranks"), on).drop(*of)
    q = beside(q, a, group, ["_px", "_py", F.col("n").alias("_n")])
    dx, dy, w = F.col("_x") - F.col("_px"), F.col("_y") - F.col("_py"), F.col("_c").cast("double")
    rx, ry = (F.col(r) - (F.col("_n") + 1) / F.lit(2.0) for r in ("_rx", "_ry"))
    n = F.sum(w)
    m = q.groupBy(*group).agg(
        (F.sum(w * dx * dy) / n - F.sum(w * dx) / n * (F.sum(w * dy) / n)).alias("_cxy"),
        F.sqrt(F.sum(w * dx * dx) / n - F.pow(F.sum(w * dx) / n, 2)).alias("_sx"),
        F.sqrt(F.sum(w * dy * dy) / n - F.pow(F.sum(w * dy) / n, 2)).alias("_sy"),
        (F.sum(w * rx * ry) / n).alias("_crr"),
        F.sqrt(F.sum(w * rx * rx) / n).alias("_srx"),
        F.sqrt(F.sum(w * ry * ry) / n).alias("_sry"),
    )
    return united(a.select(*group, "n", *GUARDS), m, group)


def _moments_collapsed(d: DataFrame, group: list[str]) -> DataFrame:
    """Per-group pair count, guards and co-moments from *collapsed* pairs.

    1. identical (x, y) rows are counted per group -- copies collapse in the map-side
       partial aggregate, before any shuffle (rows without a pair collapse too and
       keep their group alive with n = 0);
    2. one window partitioning by the group then holds the group's distinct pairs
       (at most the distinct weeks of one entity, however many copies exist):
       weighted means for a two-pass (centered, stable) covariance, and for
       Spearman the average rank of a value = (count of values <= it) - (its
       count - 1) / 2 from a RANGE running sum ordered by the value;
    3. the final aggregate reuses that partitioning (no further shuffle).
    """
    whole = group or ["_all"]  # without a group: one series
    p = (d if group else d.withColumn("_all", F.lit(0))).groupBy(*whole, "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    pair = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    w = F.when(pair, F.col("_c").cast("double"))
    part = Window.partitionBy(*whole)
    n_all = F.sum(w).over(part)
    cols = {
        "_w": w,
        "_mx": F.sum(w * F.col("_x")).over(part) / n_all,
        "_my": F.sum(w * F.col("_y")).over(part) / n_all,
    }
    cols["_half"] = (n_all + 1.0) / 2.0  # mean of the average ranks
    for v, name in (("_x", "_rx"), ("_y", "_ry")):
        k = F.when(pair, F.col(v))
        upto = part.orderBy(k).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        ties = Window.partitionBy(*whole, k)
        cols[name] = F.when(pair, F.sum(w).over(upto) - (F.sum(w).over(ties) - 1.0) / 2.0)
    q = p.withColumns(cols)
    dx, dy = F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my")
    wt = F.col("_w")
    n = F.coalesce(F.sum(wt), F.lit(0.0))
    aggs = [
        n.cast("long").alias("n"),
        F.min(F.when(pair, F.col("_x"))).alias("_minx"),
        F.max(F.when(pair, F.col("_x"))).alias("_maxx"),
        F.min(F.when(pair, F.col("_y"))).alias("_miny"),
        F.max(F.when(pair, F.col("_y"))).alias("_maxy"),
        (F.sum(wt * dx * dy) / n).alias("_cxy"),
        F.sqrt(F.sum(wt * dx * dx) / n).alias("_sx"),
        F.sqrt(F.sum(wt * dy * dy) / n).alias("_sy"),
    ]
    rx, ry = F.col("_rx") - F.col("_half"), F.col("_ry") - F.col("_half")
    aggs += [
        (F.sum(wt * rx * ry) / n).alias("_crr"),
        F.sqrt(F.sum(wt * rx * rx) / n).alias("_srx"),
        F.sqrt(F.sum(wt * ry * ry) / n).alias("_sry"),
    ]
    return q.groupBy(*group).agg(*aggs)


def pair_stats(
    df: DataFrame,
    x: str,
    y: str,
    group: Sequence[str],
    methods: Iterable[str] = METHODS,
    min_n: int = MIN_PAIRS,
    rank_strategy: str = "collapsed",
) -> DataFrame:
    """Correlation of x and y per group after dropping pairs with a NULL.

    Output: group columns, method, r, p_value, n. r/p are NULL when fewer than
    `min_n` pairs survive or either side is constant; n is always reported.
    Pearson alone needs no ranks: its co-moments merge, whatever the strategy but ``window``.
    ``collapsed`` (default): identical pairs are counted map-side first and every
    moment is computed over the distinct pairs of a group in windows, so duplicated rows never
    pile up in one task; for groups whose distinct pairs are bounded, as by the calendar.
    ``ranged``: ranks by range and prefix sums, no window over a group, for groups of any size;
    writes its counts below the checkpoint root at once. ``window``: ranks every row with rank
    windows partitioned by the group (for groups known to be small).
    """
    methods = check_methods(methods)
    if rank_strategy not in RANK_STRATEGIES:
        raise ValueError(f"rank_strategy must be one of {RANK_STRATEGIES}")
    group = list(group)
    pair = nan_to_null(F.col(x)).isNotNull() & nan_to_null(F.col(y)).isNotNull()
    d = df.select(*group, F.when(pair, F.col(x).cast("double")).alias("_x"), F.when(pair, F.col(y).cast("double")).alias("_y"))
    spearman = "spearman" in methods
    if rank_strategy != "window" and not spearman:
        a = _moments_merged(d, group)
    elif rank_strategy == "ranged":
        a = _moments_ranged(d, group)
    elif rank_strategy == "collapsed":
        a = _moments_collapsed(d, group)
    else:
        d = d.withColumn("_pair", F.col("_x").isNotNull())
        if spearman:
            d = d.withColumns({"_rx": avg_rank("_x", group, F.col("_pair")), "_ry": avg_rank("_y", group, F.col("_pair"))})
        aggs = [
            F.sum(F.col("_pair").cast("long")).alias("n"),
            F.min("_x").alias("_minx"),
            F.max("_x").alias("_maxx"),
            F.min("_y").alias("_miny"),
            F.max("_y").alias("_maxy"),
            F.covar_pop("_x", "_y").alias("_cxy"),
            F.stddev_pop("_x").alias("_sx"),
            F.stddev_pop("_y").alias("_sy"),
        ]
        if spearman:
            aggs += [F.covar_pop("_rx", "_ry").alias("_crr"), F.stddev_pop("_rx").alias("_srx"), F.stddev_pop("_ry").alias("_sry")]
        a = d.groupBy(*group).agg(*aggs)
    n_c = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    guards = (F.col("_minx"), F.col("_maxx"), F.col("_miny"), F.col("_maxy"))
    rows = []
    for m in methods:
        if m == "pearson":
            r = guarded_r(F.col("_cxy"), F.col("_sx"), F.col("_sy"), n_c, *guards, min_n=min_n)
        else:
            r = guarded_r(F.col("_crr"), F.col("_srx"), F.col("_sry"), n_c, *guards, min_n=min_n)
        rows.append(F.struct(F.lit(m).alias("method"), r.alias("r")))
    out = a.select(*group, n_c.alias("n"), F.inline(F.array(*rows)))
    return with_pvalue(out).select(*group, "method", "r", "p_value", "n")


def _explode_lags(cases: DataFrame, target: str, lags: Sequence[int], keys: list[str], system: str) -> DataFrame:
    idx = cal.week_index(F.col(YEAR), F.col(WEEK), system)
    c = cases.select(*keys, idx.alias("_idx"), nan_to_null(F.col(target).cast("double")).alias("_y"))
    c = c.withColumn("lag", F.explode(F.array(*[F.lit(int(l)) for l in lags])))
    return c.select(*keys, "lag", (F.col("_idx") - F.col("lag")).alias("_src"), "_y")


def _joined_long(cases_x: DataFrame, frame: DataFrame, variables: Sequence[str], keys: list[str], system: str, source: str | None):
    missing = [v for v in variables if v not in frame.columns]
    if missing:
        raise KeyError(f"variables {missing} not found; available: {frame.columns}")
    idx = cal.week_index(F.col(YEAR), F.col(WEEK), system)
    k = frame.select(*keys, idx.alias("_src"), *[nan_to_null(F.col(v).cast("double")).alias(v) for v in variables])
    j = cases_x.join(k, [*keys, "_src"], "left")
    long = j.unpivot([*keys, "lag", "_y"], list(variables), "variable", "_x")
    if source is not None:
        long = long.withColumn("source", F.lit(source))
    return long


def _empty(spark, keys_schema: list[T.StructField], with_source: bool) -> DataFrame:
    fields = list(keys_schema)
    if with_source:
        fields.append(T.StructField("source", T.StringType()))
    fields += [
        T.StructField("variable", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("lag", T.IntegerType()),
        T.StructField("r", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
    return spark.createDataFrame([], T.StructType(fields))


def corr_sweep(
    cases: DataFrame,
    sources: Mapping[str | None, tuple[DataFrame, Sequence[str]]],
    lags: Iterable[int] = range(0, 9),
    target: str = "incidence",
    methods: Iterable[str] = METHODS,
    keys=None,
    system: str = "iso",
) -> DataFrame:
    """Correlation of `target` with every (source, variable) at every lag, in one job."""
    keys = _keys(keys)
    methods = check_methods(methods)
    lags = [int(l) for l in lags]
    if target not in cases.columns:
        raise KeyError(f"target column {target!r} not found; available: {cases.columns}")
    with_source = any(s is not None for s in sources)
    srcs = {s: (f, list(v)) for s, (f, v) in sources.items() if list(v)}
    if not srcs or not lags:
        return _empty(cases.sparkSession, [cases.schema[k] for k in keys], with_source)
    cases_x = _explode_lags(cases, target, lags, keys, system)
    parts = [_joined_long(cases_x, f, v, keys, system, s) for s, (f, v) in srcs.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    group = [*keys, *(["source"] if with_source else []), "variable", "lag"]
    out = pair_stats(long, "_x", "_y", group, methods)
    return out.select(*keys, *(["source"] if with_source else []), *SWEEP_COLUMNS)


def lag_sweep(cases, climate, variable: str, lags=range(0, 9), target="incidence", methods=METHODS, keys=None, system="iso"):
    """One variable x lags x methods -> (keys, variable, method, lag, r, p_value, n) (E5)."""
    return corr_sweep(cases, {None: (climate, [variable])}, lags, target, methods, keys, system)


def corr_matrix(cases, climate, variables, lags=range(0, 9), target="incidence", methods=METHODS, keys=None, system="iso"):
    """Many variables; no variables -> empty frame with the six columns."""
    return corr_sweep(cases, {None: (climate, list(variables))}, lags, target, methods, keys, system)


def corr_matrix_sources(cases, sources: Mapping[str, tuple[DataFrame, Sequence[str]]], lags=range(0, 9), target="incidence", methods=METHODS, keys=None, system="iso"):
    """Several driver tables at once, each row tagged with its `source`."""
    return corr_sweep(cases, dict(sources), lags, target, methods, keys, system)


def correlate(df: DataFrame, x: str, y: str, keys=None, methods=METHODS, rank_strategy: str = "ranged") -> DataFrame:
    """Correlation of two columns of one frame, per entity (E2/E3 on a frame), for entities of
    any size."""
    return pair_stats(df, x, y, _keys(keys), methods, rank_strategy=rank_strategy)
