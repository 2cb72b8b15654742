"""Feature screening on top of the correlation results.

Everything here is either a window over small per-entity groups (a weekly series,
or the 9-lag block of one variable) or a single aggregate whose output size is
bounded by the number of features, never by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pvalue import with_pvalue
from ..functions.scalars import nan_to_null
from .correlation import clamped_r, METHODS, guarded_r, pair_stats
from .groups import beside
from .rollup import YEAR, _keys

PARTIAL_MIN_N = 5
SIG_ABS_R = 0.15
SIG_P = 0.05


# ------------------------------------------------------------------ E8 best lag
def best_lag(matrix: DataFrame, keys=None, by: Sequence[str] = ("variable", "method")) -> DataFrame:
    """Row with the largest |r| per (keys, variable, method); ties -> smaller lag.

    A group whose r are all NULL keeps its smallest lag with NULL r.
    """
    group = [*_keys(keys), *[b for b in by if b in matrix.columns]]
    if "source" in matrix.columns and "source" not in group:
        group.insert(len(_keys(keys)), "source")
    w = Window.partitionBy(*group).orderBy(F.abs("r").desc_nulls_last(), F.col("lag").asc())
    return matrix.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn").withColumn(
        "abs_r", F.abs("r")
    )


# ------------------------------------------------------------------ E9 / E10 pivots
def corr_pivot(matrix: DataFrame, variables: Sequence[str], keys=None, index: Sequence[str] = ("method", "lag")) -> DataFrame:
    """lag x variable table of r (E9); the variable list is known up front (no extra job)."""
    return matrix.groupBy(*_keys(keys), *index).pivot("variable", list(variables)).agg(F.first("r"))


def corr_pivot_multi(
    matrix: DataFrame,
    headers: Sequence[tuple[str, str, str]],
    keys=None,
    digits: int = 3,
) -> DataFrame:
    """Pivot table indexed by lag with one column per (source, variable, method),
    averaging duplicates and rounding (E10). Column name: source_variable_method."""
    label = F.concat_ws("_", F.col("source"), F.col("variable"), F.col("method"))
    names = ["_".join(h) for h in headers]
    p = matrix.withColumn("_h", label).groupBy(*_keys(keys), "lag").pivot("_h", names).agg(F.avg("r"))
    return p.select(*_keys(keys), "lag", *[F.round(F.col(n), digits).alias(n) for n in names])


# ------------------------------------------------------------------ B14 / B15
def zscore(df: DataFrame, cols: Sequence[str], keys=None, suffix: str = "z_") -> DataFrame:
    """Add z-scores (sample std, as pandas) per entity; NULL when the column is constant.

    With keys a window per entity: one weekly series, bounded by the calendar. Without keys the
    moments are one aggregate (partial sums on every task) set beside the rows.
    """
    keys = _keys(keys)
    value = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
    parts = {"low": F.min, "high": F.max, "mean": F.avg, "sd": F.stddev_samp}
    found = {f"_{p}_{c}": fn(v) for c, v in value.items() for p, fn in parts.items()}
    if keys:
        w = Window.partitionBy(*keys)
        d = df.withColumns({n: agg.over(w) for n, agg in found.items()})
    else:
        d = beside(df, df.agg(*[agg.alias(n) for n, agg in found.items()]), [], list(found))
    out = {f"{suffix}{c}": F.when(F.col(f"_low_{c}") < F.col(f"_high_{c}"), F.try_divide(v - F.col(f"_mean_{c}"), F.col(f"_sd_{c}"))) for c, v in value.items()}
    return d.withColumns(out).drop(*found)


def interaction(df: DataFrame, a: str, b: str, keys=None, name: str | None = None) -> DataFrame:
    """Product of the z-scores of two columns."""
    name = name or f"{a}_x_{b}"
    z = zscore(df, [a, b], keys, suffix="_z_")
    return z.withColumn(name, F.col(f"_z_{a}") * F.col(f"_z_{b}")).drop(f"_z_{a}", f"_z_{b}")


# ------------------------------------------------------------------ E11 / E12 partial correlation
def _corr_cols(x: Column, y: Column, n: Column) -> Column:
    """Aggregate expressions for a guarded Pearson r between two columns (listwise rows)."""
    return guarded_r(F.covar_pop(x, y), F.stddev_pop(x), F.stddev_pop(y), n, F.min(x), F.max(x), F.min(y), F.max(y), min_n=1)


def _partial(rxy: Column, rxz: Column, ryz: Column) -> Column:
    r = F.try_divide(rxy - rxz * ryz, F.sqrt((1.0 - rxz * rxz) * (1.0 - ryz * ryz)))
    return clamped_r(r)


def partial_corr(df: DataFrame, x: str, y: str, z: str, keys=None, min_n: int = PARTIAL_MIN_N, df_adjust: int = 0) -> DataFrame:
    """Partial Pearson correlation of x and y controlling z.

    Listwise deletion; equals the Pearson correlation of the residuals of x~z and
    y~z. NULL when n < min_n. p uses n-2 degrees of freedom like the original
    (``df_adjust=1`` gives the textbook n-3).
    """
    keys = _keys(keys)
    d = df.select(*keys, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in (x, y, z)]).filter(
        F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(z).isNotNull()
    )
    n = F.count(F.lit(1))
    a = d.groupBy(*keys).agg(
        n.alias("n"),
        _corr_cols(F.col(x), F.col(y), n).alias("rxy"),
        _corr_cols(F.col(x), F.col(z), n).alias("rxz"),
        _corr_cols(F.col(y), F.col(z), n).alias("ryz"),
    )
    r = F.when(F.col("n") >= min_n, _partial(F.col("rxy"), F.col("rxz"), F.col("ryz")))
    out = a.select(*keys, r.alias("r_partial"), "n")
    return with_pvalue(out, "r_partial", "n", "p_value", df_adjust).select(*keys, "r_partial", "p_value", "n")


def partial_table(
    df: DataFrame,
    target: str,
    features: Mapping[str, str],
    pairs: Sequence[tuple[str, str]],
    keys=None,
    min_n: int = PARTIAL_MIN_N,
    sig_abs_r: float = SIG_ABS_R,
    sig_p: float = SIG_P,
) -> DataFrame:
    """Partial correlation with the target for ordered (variable, control) pairs, in one
    aggregate over listwise-complete rows, plus a significance flag (E12).

    features: label -> column; pairs: (variable label, control label).
    """
    keys = _keys(keys)
    cols = {target: target, **features}
    d = df.select(*keys, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in dict.fromkeys(cols.values())])
    d = d.dropna(subset=list(dict.fromkeys(cols.values())))
    n = F.count(F.lit(1))
    labels = list(features)
    aggs = [n.alias("n")]
    for i, a in enumerate(labels):
        aggs.append(_corr_cols(F.col(features[a]), F.col(target), n).alias(f"_r_{a}_y"))
        for b in labels[i + 1 :]:
            aggs.append(_corr_cols(F.col(features[a]), F.col(features[b]), n).alias(f"_r_{a}_{b}"))
    a = d.groupBy(*keys).agg(*aggs)

    def rr(p, q):
        return F.col(f"_r_{p}_{q}") if labels.index(p) < labels.index(q) else F.col(f"_r_{q}_{p}")

    rows = []
    for var, ctrl in pairs:
        r = F.when(F.col("n") >= min_n, _partial(F.col(f"_r_{var}_y"), rr(var, ctrl), F.col(f"_r_{ctrl}_y")))
        rows.append(F.struct(F.lit(var).alias("variable"), F.lit(ctrl).alias("control"), r.alias("r_partial")))
    out = a.select(*keys, "n", F.inline(F.array(*rows)))
    out = with_pvalue(out, "r_partial", "n", "p_value")
    sig = F.coalesce((F.abs("r_partial") > sig_abs_r) & (F.col("p_value") < sig_p), F.lit(False))
    return out.select(*keys, "variable", "control", "r_partial", "p_value", "n", sig.alias("significant"))


def recommend_features(partials: DataFrame, keys=None) -> DataFrame:
    """Distinct variables with a significant partial correlation, sorted."""
    keys = _keys(keys)
    return partials.filter("significant").select(*keys, "variable").distinct().orderBy(*keys, "variable")


# ------------------------------------------------------------------ E13 VIF
PIVOT = 1e-10  # a standardized column with less left of it is determined by earlier ones


def vif_status(v: Column) -> Column:
    return F.when(v > 10, "high").when(v < 5, "ok").otherwise("moderate")


def vif(df: DataFrame, cols: Sequence[str], keys=None, digits: int = 2, tol: float = 1e-12) -> DataFrame:
    """Variance inflation factors of `cols` per entity after listwise deletion.

    VIF = 1 / (1 - R^2) of each column regressed on all the others. A constant column
    gets 1 and explains nothing; a column that the others determine gets +inf, the
    columns it does not involve keep their own value. One aggregate gathers the k x k
    co-moments of each entity; on those rows each column's regression eliminates the
    others from the correlation matrix one by one, in the order of `cols`, leaving out those
    that earlier ones determine; what is left on the column's diagonal is 1 - R^2.
    """
    keys, cols = _keys(keys), list(cols)
    k = len(cols)
    d = df.select(*keys, *[nan_to_null(F.col(c).cast("double")).alias(f"_c{i}") for i, c in enumerate(cols)])
    d = d.dropna(subset=[f"_c{i}" for i in range(k)])
    live = [(F.min(f"_c{i}") < F.max(f"_c{i}")).alias(f"_live{i}") for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    a = d.groupBy(*keys).agg(*live, *[F.covar_pop(f"_c{i}", f"_c{j}").alias(f"_m{i}_{j}") for i, j in pairs])
    both = {(i, j): F.coalesce(F.col(f"_live{i}") & F.col(f"_live{j}"), F.lit(False)) for i, j in pairs}
    r = {(i, j): F.when(both[i, j], F.try_divide(F.col(f"_m{i}_{j}"), F.sqrt(F.col(f"_m{i}_{i}")) * F.sqrt(F.col(f"_m{j}_{j}")))).otherwise(F.lit(0.0)) for i, j in pairs}
    finite = F.lit(True)
    for c in r.values():
        finite = finite & F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False))
    flat = F.array(*[F.when(both[i, i], F.lit(1.0)).otherwise(F.lit(0.0)) if i == j else r[min(i, j), max(i, j)] for i in range(k) for j in range(k)])
    a = a.select(*keys, *[both[i, i].alias(f"_live{i}") for i in range(k)], F.when(finite, flat).alias("_r"))

    def eliminated(m: Column, p: Column) -> Column:
        """The matrix (row by row) without what column ``p`` explains."""
        at = lambda row, col: F.get(m, row * k + col)
        less = F.transform(m, lambda v, q: v - at(F.floor(q / k).cast("int"), p) * at(p, q % k) / at(p, p))
        return F.when(at(p, p) > PIVOT, less).otherwise(m)

    rows = []
    for i, c in enumerate(cols):
        others = F.array(*[F.lit(j) for j in range(k) if j != i]) if k > 1 else F.array().cast("array<int>")
        left = F.get(F.aggregate(others, F.col("_r"), eliminated), F.lit(i * k + i))
        inflation = F.when(left > tol, F.round(1.0 / left, digits)).otherwise(F.lit(float("inf")))
        value = F.when(~F.col(f"_live{i}"), F.lit(1.0)).when(F.col("_r").isNotNull(), inflation)
        rows.append(F.struct(F.lit(c).alias("variable"), value.alias("vif")))
    out = a.select(*keys, F.inline(F.array(*rows)))
    return out.withColumn("status", vif_status(F.col("vif")))


# ------------------------------------------------------------------ E14 / E15
def yearly_stability(df: DataFrame, target: str, features: Mapping[str, str], keys=None, min_n: int = 10, method: str = "spearman") -> DataFrame:
    """Correlation of each feature with the target per (keys, year); years with n < min_n dropped."""
    keys = _keys(keys)
    long = df.select(
        *keys,
        YEAR,
        F.col(target).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("variable"), F.col(c).cast("double").alias("_x")) for k, c in features.items()])).alias("_kv"),
    ).select(*keys, YEAR, "_y", "_kv.variable", "_kv._x")
    res = pair_stats(long, "_x", "_y", [*keys, YEAR, "variable"], [method])
    return res.filter(F.col("n") >= min_n).select(*keys, YEAR, "variable", "r", "n")


def corr_ranking(df: DataFrame, target: str, features: Mapping[str, str], keys=None, methods=METHODS) -> DataFrame:
    """Correlation of every feature with the target, ranked by |r|."""
    keys = _keys(keys)
    long = df.select(
        *keys,
        F.col(target).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("variable"), F.col(c).cast("double").alias("_x")) for k, c in features.items()])).alias("_kv"),
    ).select(*keys, "_y", "_kv.variable", "_kv._x")
    res = pair_stats(long, "_x", "_y", [*keys, "variable"], methods)
    w = Window.partitionBy(*keys).orderBy(F.abs("r").desc_nulls_last(), "variable", "method")
    return res.withColumn("rank", F.row_number().over(w))
