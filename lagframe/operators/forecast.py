"""Forecast back-testing.

The baseline is a window expression over all folds at once. The forest is
MLlib's distributed RandomForestRegressor, refit per fold on *all* entities
pooled (train = every row strictly before the fold's first test week, cut on
the integer week index so no entity leaks future weeks). The model frame is
checkpointed to the shared checkpoint folder once, so each fold re-reads it
instead of recomputing its lineage (and survives executor loss).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.scalars import clamp_nonneg, nan_to_null
from ..session import ensure_checkpoint_dir
from .lagjoin import lag_join
from .rollup import WEEK, YEAR, _keys

MIN_TRAIN = 52
BASELINE_WINDOW = 4
AR_LAGS = (1, 2, 3, 4)
# Forest parameters of the original study.
FOREST = dict(num_trees=200, max_depth=8, min_leaf=5, seed=42)
# Candidate cuts per feature. MLlib bins continuous features; with as many bins as distinct
# values every cut between neighbours is a candidate, as in an exact split search.
MAX_BINS = 512
# MLlib training knobs (do not change the fitted model): node ids cached between
# levels instead of re-derived from the trees, and a larger per-pass node budget so
# a level of all 200 trees is split in fewer passes over the data.
TRAINING = dict(max_memory_mb=1024, cache_node_ids=True)


def _ordered(keys) -> Window:
    return Window.partitionBy(*_keys(keys)).orderBy(YEAR, WEEK)


def autoreg_features(
    df: DataFrame,
    target: str,
    lags: Sequence[int] = AR_LAGS,
    keys=None,
    prefix: str = "cases_lag",
    mode: str = "positional",
    system: str = "iso",
) -> DataFrame:
    """Previous values of the target as features (F2).

    positional: the k-th previous row of the entity (the original's shift);
    calendar: the value exactly k weeks earlier (NULL if that week is missing).
    Windows are partitioned by the entity (a weekly series).
    """
    keys = _keys(keys)
    if mode == "positional":
        w = _ordered(keys)
        return df.withColumns({f"{prefix}{k}": F.lag(target, k).over(w) for k in lags})
    if mode == "calendar":
        idx = cal.week_index(F.col(YEAR), F.col(WEEK), system)
        w = Window.partitionBy(*keys).orderBy(idx)
        return df.withColumns({f"{prefix}{k}": F.max(target).over(w.rangeBetween(-k, -k)) for k in lags})
    raise ValueError("mode must be 'positional' or 'calendar'")


def baseline_forecast(
    df: DataFrame,
    target: str,
    window: int = BASELINE_WINDOW,
    keys=None,
    name: str = "pred_baseline",
    mode: str = "positional",
    system: str = "iso",
) -> DataFrame:
    """Mean of the previous `window` values, clamped at 0.

    positional: the previous `window` rows of the entity (the original);
    calendar: the rows of the previous `window` calendar weeks (missing weeks shrink
    the mean instead of reaching further back).
    """
    if mode == "positional":
        w = _ordered(keys).rowsBetween(-window, -1)
    elif mode == "calendar":
        idx = cal.week_index(F.col(YEAR), F.col(WEEK), system)
        w = Window.partitionBy(*_keys(keys)).orderBy(idx).rangeBetween(-window, -1)
    else:
        raise ValueError("mode must be 'positional' or 'calendar'")
    return df.withColumn(name, clamp_nonneg(F.avg(nan_to_null(F.col(target).cast("double"))).over(w)))


def walk_forward_folds(df: DataFrame, keys=None, min_train: int = MIN_TRAIN) -> DataFrame:
    """Row position per entity and its role: rows after the first `min_train` are test rows."""
    return df.withColumn("row_no", F.row_number().over(_ordered(keys))).withColumn(
        "is_test", F.col("row_no") > min_train
    )


def model_frame(
    cases: DataFrame,
    drivers: Sequence[tuple[DataFrame, str]],
    target: str,
    lag: int = 8,
    ar_lags: Sequence[int] = AR_LAGS,
    keys=None,
    ar_prefix: str = "cases_lag",
) -> DataFrame:
    """cases x lagged drivers, + autoregressive target lags, complete rows only.

    The drivers are chained lag joins on the same (entity, week index) key, so the
    outcome side is shuffled once and every further join reuses its partitioning
    (the original's inner merge of separately joined frames gives the same rows
    when the outcome has one row per entity-week).
    """
    keys = _keys(keys)
    f = cases.select(*keys, YEAR, WEEK, target)
    for frame, col in drivers:
        f = lag_join(f, frame.select(*keys, YEAR, WEEK, col), lag=lag, keys=keys, value_cols=[col])
    f = autoreg_features(f, target, ar_lags, keys, prefix=ar_prefix)
    return f.dropna()


LABEL = "_label"


def _assembled(df: DataFrame, features: Sequence[str], out: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def _forest(vector: str, pred: str, params: Mapping):
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(
        featuresCol=vector,
        labelCol=LABEL,
        predictionCol=pred,
        maxBins=int(params.get("max_bins", MAX_BINS)),
        numTrees=int(params["num_trees"]),
        maxDepth=int(params["max_depth"]),
        minInstancesPerNode=int(params["min_leaf"]),
        seed=int(params["seed"]),
        featureSubsetStrategy="all",
        maxMemoryInMB=int(params.get("max_memory_mb", TRAINING["max_memory_mb"])),
        cacheNodeIds=bool(params.get("cache_node_ids", TRAINING["cache_node_ids"])),
    )


def walk_forward_rf(
    frame: DataFrame,
    target: str,
    climate_features: Sequence[str],
    full_features: Sequence[str],
    keys=None,
    min_train: int = MIN_TRAIN,
    refit_every: int = 1,
    baseline_window: int = BASELINE_WINDOW,
    forest: Mapping | None = None,
    system: str = "iso",
    parallelism: int = 8,
) -> DataFrame:
    """One-step-ahead walk-forward: baseline, forest on climate, forest on climate + AR.

    refit_every=1 refits every week like the original; larger values refit every N
    weeks (each fold predicts N weeks with the model trained before it). Folds are
    independent, so up to `parallelism` fits run as concurrent Spark jobs (as
    CrossValidator's ``parallelism`` does); each fit is itself distributed. The result is a
    union with a branch per fold: for refits every few weeks use
    ``weekly_forest.walk_forward_weekly``, which deals the fits of each series to tasks.
    Output: keys, year, week, real, pred_baseline, pred_rf_climate, pred_rf_full.
    """
    keys = _keys(keys)
    params = dict(FOREST)
    params.update(forest or {})
    ensure_checkpoint_dir(frame.sparkSession)
    f = baseline_forecast(frame, target, baseline_window, keys)
    f = walk_forward_folds(f, keys, min_train)
    f = f.withColumn("_idx", cal.week_index(F.col(YEAR), F.col(WEEK), system))
    f = _assembled(_assembled(f, climate_features, "_vec_climate"), full_features, "_vec_full")
    f = f.withColumn(LABEL, F.col(target).cast("double"))
    f = f.checkpoint(eager=True)  # reliable checkpoint: reused by every fold
    t0 = f.filter("is_test").agg(F.min("_idx")).first()[0]
    schema = T.StructType(
        [f.schema[k] for k in keys]
        + [
            T.StructField(YEAR, T.IntegerType()),
            T.StructField(WEEK, T.IntegerType()),
            T.StructField("real", T.DoubleType()),
            T.StructField("pred_baseline", T.DoubleType()),
            T.StructField("pred_rf_climate", T.DoubleType()),
            T.StructField("pred_rf_full", T.DoubleType()),
        ]
    )
    if t0 is None:
        return frame.sparkSession.createDataFrame([], schema)
    test = f.filter("is_test").withColumn("_fold", F.floor((F.col("_idx") - t0) / refit_every).cast("int"))
    folds = [r[0] for r in test.select("_fold").distinct().orderBy("_fold").collect()]  # bounded by weeks / refit_every

    def fit(task):
        k, vector, pred = task
        train = f.filter(F.col("_idx") < t0 + k * refit_every).select(vector, LABEL)
        return (k, pred), _forest(vector, pred, params).fit(train)

    tasks = [(k, vector, pred) for k in folds for vector, pred in (("_vec_climate", "pred_rf_climate"), ("_vec_full", "pred_rf_full"))]
    models = dict(_run_parallel(fit, tasks, parallelism, f.sparkSession))
    parts = []
    for k in folds:
        tst = test.filter(F.col("_fold") == k)
        p = models[(k, "pred_rf_full")].transform(models[(k, "pred_rf_climate")].transform(tst))
        parts.append(
            p.select(
                *keys,
                YEAR,
                WEEK,
                F.col(target).cast("double").alias("real"),
                "pred_baseline",
                clamp_nonneg("pred_rf_climate").alias("pred_rf_climate"),
                clamp_nonneg("pred_rf_full").alias("pred_rf_full"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _run_parallel(fn, tasks, parallelism: int, spark=None):
    """Run independent driver-side job submissions (forest fits) on a thread pool;
    each thread inherits the session's job tags/properties."""
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    if parallelism <= 1 or len(tasks) <= 1:
        return [fn(t) for t in tasks]
    wrap = inheritable_thread_target(spark) if spark is not None else inheritable_thread_target
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(wrap(fn), tasks)


def feature_importance(frame: DataFrame, target: str, features: Sequence[str], forest: Mapping | None = None) -> DataFrame:
    """Importances of a final forest fit on all rows, largest first.

    The frame is checkpointed first: the forest reads its input several times
    (split finding, binning, bagging) and must not recompute the lineage each time.
    """
    params = dict(FOREST)
    params.update(forest or {})
    ensure_checkpoint_dir(frame.sparkSession)
    d = _assembled(frame.withColumn(LABEL, F.col(target).cast("double")), features, "_vec").select("_vec", LABEL).checkpoint(eager=True)
    imp = _forest("_vec", "_pred", params).fit(d).featureImportances.toArray()
    rows = sorted(((c, float(v)) for c, v in zip(features, imp)), key=lambda t: -t[1])
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return frame.sparkSession.createDataFrame(rows, schema)


def forecast_metrics(
    preds: DataFrame,
    models: Mapping[str, str],
    real: str = "real",
    keys=None,
    by: Sequence[str] = (),
    constant_r2: str = "finite",
) -> DataFrame:
    """MAE, RMSE, R^2 and MAPE% (rows with real > 0 only) per model.

    Constant actual values: ``constant_r2="finite"`` gives 1.0 for a perfect fit and
    0.0 otherwise (the convention of the original's overall metrics), ``"null"`` gives
    NULL (its per-year table). Rows without an actual value or a forecast (NULL, NaN) do not
    count. MAPE is NULL with no real > 0. Models are unpivoted to
    rows so one aggregate serves all of them.
    """
    group = [*_keys(keys), *by]
    long = preds.select(
        *group,
        nan_to_null(F.col(real).cast("double")).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("model"), nan_to_null(F.col(c).cast("double")).alias("_p")) for m, c in models.items()])).alias("_m"),
    ).select(*group, "_y", "_m.model", "_m._p")
    long = long.withColumns({"_y": F.when(F.col("_p").isNotNull(), F.col("_y")), "_p": F.when(F.col("_y").isNotNull(), F.col("_p"))})
    e = F.col("_p") - F.col("_y")
    n = F.count("_y")
    sst = F.var_pop("_y") * n
    agg = long.groupBy(*group, "model").agg(
        n.alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(F.min("_y") < F.max("_y"), 1.0 - F.try_divide(F.sum(e * e), sst))
        .when(F.lit(constant_r2 == "finite"), F.when(F.sum(e * e) == 0.0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("r2"),
        (F.avg(F.when(F.col("_y") > 0, F.abs(e / F.col("_y")))) * 100.0).alias("mape"),
    )
    return agg


def metrics_by_year(preds: DataFrame, models: Mapping[str, str], real: str = "real", keys=None, min_n: int = 10) -> DataFrame:
    """forecast_metrics per year, years with fewer than `min_n` rows dropped."""
    m = forecast_metrics(preds, models, real, keys, by=[YEAR], constant_r2="null")
    return m.filter(F.col("n") >= min_n)


def winner_by_year(by_year: DataFrame, model: str, baseline: str = "baseline", keys=None) -> DataFrame:
    """Per year: the model wins iff its MAE is below the baseline's."""
    group = [*_keys(keys), YEAR]
    p = by_year.groupBy(*group).agg(
        F.max(F.when(F.col("model") == baseline, F.col("mae"))).alias("mae_baseline"),
        F.max(F.when(F.col("model") == model, F.col("mae"))).alias("mae_model"),
        F.max(F.when(F.col("model") == model, F.col("r2"))).alias("r2_model"),
        F.max("n").alias("n"),
    )
    return p.withColumn("winner", F.when(F.col("mae_model") < F.col("mae_baseline"), F.lit(model)).otherwise(F.lit(baseline)))


def gain_vs_baseline(metrics: DataFrame, baseline: str = "baseline", keys=None) -> DataFrame:
    """(1 - MAE / MAE_baseline) * 100 for every model."""
    keys = _keys(keys)
    w = Window.partitionBy(*keys)
    bl = F.max(F.when(F.col("model") == baseline, F.col("mae"))).over(w)
    return metrics.select(*keys, "model", "mae", ((1.0 - F.try_divide(F.col("mae"), bl)) * 100.0).alias("gain_pct"))
