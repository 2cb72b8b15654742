"""Registered forecasting queries (D3, F2-F4, I1-I3, E17-E19) and their oracles.

Model frame (as the original's modelling step): outcome x lag-8 minimum driver
(climate) x lag-8 vegetation index (satellite), inner-joined, plus the previous
four outcome values, complete rows only. The forest keys get a rows-only check.
"""

from __future__ import annotations

from ..operators import forecast as FC
from ..operators import lagjoin as LJ
from ..operators.weekly_forest import forest_importance, walk_forward_weekly
from ..session import scratch_path
from . import oracle as O
from . import oracle_trees as OT
from . import views as V
from .catalog import REGION, register, rounded, rsql

LAG = 8
AR = [1, 2, 3, 4]
CLIMATE_FEATURES = ["qty_min_lag8", "ndvi_lag8"]
AR_FEATURES = [f"cases_lag{k}" for k in AR]
FULL_FEATURES = CLIMATE_FEATURES + AR_FEATURES
# the pooled variant fits MLlib forests on all places at once, anew every 52 weeks
POOLED_REFIT_EVERY = 52

_W = "PARTITION BY region ORDER BY year, week"
O.cte(
    "mf0",
    f"""SELECT c.region, c.year, c.week, c.incidence, k.qty_min_lag8, s.ndvi_lag8
FROM cases_idx c
LEFT JOIN ({O.lagged_sql('weekly_idx', LAG, ['qty_min'], REGION)}) k ON k.region = c.region AND k.tidx = c.idx
LEFT JOIN ({O.lagged_sql('sat_weekly_idx', LAG, ['ndvi'], REGION)}) s ON s.region = c.region AND s.tidx = c.idx""",
    "cases_idx",
    "weekly_idx",
    "sat_weekly_idx",
)
O.cte(
    "model",
    "SELECT * FROM (SELECT *, "
    + ", ".join(f"lag(incidence, {k}) OVER ({_W}) AS cases_lag{k}" for k in AR)
    + " FROM mf0) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ["incidence", *FULL_FEATURES]),
    "mf0",
)
O.cte(
    "bf",
    f"""SELECT *, CASE WHEN pb IS NOT NULL THEN greatest(0.0, pb) END AS pred_baseline FROM (
SELECT *, avg(incidence) OVER ({_W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS pb,
       row_number() OVER ({_W}) AS row_no FROM model)""",
    "model",
)
_MODEL_COLS = ["region", "year", "week", "incidence", *FULL_FEATURES]


def model_frame(spark, d):
    return FC.model_frame(
        V.cases_t(spark, d),
        [(V.weekly_t(spark, d), "qty_min"), (V.sat_weekly_t(spark, d), "ndvi")],
        "incidence",
        LAG,
        AR,
        REGION,
    )


@register(
    "feature_frame",
    O.build(f"SELECT region, year, week, {rsql('incidence')}, {rsql('qty_min_lag8')}, {rsql('ndvi_lag8')} FROM mf0", "mf0"),
)
def q_feature_frame(spark, d):
    base = V.cases_t(spark, d).select("region", "year", "week", "incidence")
    a = LJ.lag_join(base, V.weekly_t(spark, d), LAG, REGION, value_cols=["qty_min"])
    b = LJ.lag_join(base.select("region", "year", "week"), V.sat_weekly_t(spark, d), LAG, REGION, value_cols=["ndvi"])
    return rounded(LJ.feature_frame([a, b], REGION).select("region", "year", "week", "incidence", "qty_min_lag8", "ndvi_lag8"))


@register("model_frame", O.build("SELECT region, year, week, " + ", ".join(rsql(c) for c in _MODEL_COLS[3:]) + " FROM model", "model"))
def q_model_frame(spark, d):
    return rounded(model_frame(spark, d).select(*_MODEL_COLS))


@register(
    "autoreg_features",
    O.build(
        f"SELECT region, year, week, {rsql('incidence')}, "
        + ", ".join(rsql(f"lag(incidence, {k}) OVER ({_W})", alias=f"cases_lag{k}") for k in AR)
        + " FROM cases",
        "cases",
    ),
)
def q_autoreg_features(spark, d):
    c = V.cases_t(spark, d).select("region", "year", "week", "incidence")
    return rounded(FC.autoreg_features(c, "incidence", AR, REGION))


@register("baseline_forecast", O.build(f"SELECT region, year, week, {rsql('incidence')}, {rsql('pred_baseline')} FROM bf", "bf"))
def q_baseline_forecast(spark, d):
    m = model_frame(spark, d)
    return rounded(FC.baseline_forecast(m, "incidence", 4, REGION).select("region", "year", "week", "incidence", "pred_baseline"))


@register("walk_forward_folds", O.build("SELECT region, year, week, CAST(row_no AS INTEGER) AS row_no, row_no > 52 AS is_test FROM bf", "bf"))
def q_walk_forward_folds(spark, d):
    f = FC.walk_forward_folds(model_frame(spark, d), REGION)
    return f.select("region", "year", "week", "row_no", "is_test")


def _metrics_sql(by_year: bool) -> str:
    y = "year, " if by_year else ""
    e = "(pred_baseline - incidence)"
    const = "" if by_year else f"WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0"
    sel = (
        f"SELECT region, {y}'baseline' AS model, count(*) AS n, {O.rnd(f'avg(abs({e}))')} AS mae, "
        f"{O.rnd(f'sqrt(avg({e} * {e}))')} AS rmse, "
        f"{O.rnd(f'CASE WHEN min(incidence) < max(incidence) THEN 1.0 - sum({e} * {e}) / (var_pop(incidence) * count(*)) {const} END', 10)} AS r2, "
        f"{O.rnd(f'avg(CASE WHEN incidence > 0 THEN abs({e} / incidence) END) * 100.0')} AS mape "
        f"FROM bf WHERE row_no > 52 GROUP BY region, {y}model"
    )
    if by_year:
        sel = f"SELECT * FROM ({sel}) WHERE n >= 10"
    return O.build(sel, "bf")


def _baseline_preds(spark, d):
    m = FC.baseline_forecast(model_frame(spark, d), "incidence", 4, REGION)
    return FC.walk_forward_folds(m, REGION).filter("is_test")


@register("forecast_metrics", _metrics_sql(False))
def q_forecast_metrics(spark, d):
    out = FC.forecast_metrics(_baseline_preds(spark, d), {"baseline": "pred_baseline"}, real="incidence", keys=REGION)
    return rounded(out.select("region", "model", "n", "mae", "rmse", "r2", "mape"))


@register("metrics_by_year", _metrics_sql(True))
def q_metrics_by_year(spark, d):
    out = FC.metrics_by_year(_baseline_preds(spark, d), {"baseline": "pred_baseline"}, real="incidence", keys=REGION)
    return rounded(out.select("region", "year", "model", "n", "mae", "rmse", "r2", "mape"))


# the previous week as a second forecast: gain and winner have an exact answer for it
_PREVIOUS = {"baseline": "pred_baseline", "previous": "cases_lag1"}
_PREV_LONG = """SELECT region, year, incidence AS y, model, CASE model WHEN 'baseline' THEN pred_baseline ELSE cases_lag1 END AS p
FROM bf, (SELECT unnest(['baseline', 'previous']) AS model) WHERE row_no > 52"""


@register(
    "gain_previous_week",
    O.build(
        f"SELECT region, model, {rsql('mae')}, {O.rnd('(1.0 - mae / max(CASE WHEN model = $$baseline$$ THEN mae END) OVER (PARTITION BY region)) * 100.0')} AS gain_pct FROM pm",
        "bf",
        extra=[("pl", _PREV_LONG), ("pm", "SELECT region, model, avg(abs(p - y)) AS mae FROM pl GROUP BY ALL")],
    ),
)
def q_gain_previous_week(spark, d):
    m = FC.forecast_metrics(_baseline_preds(spark, d), _PREVIOUS, real="incidence", keys=REGION)
    return rounded(FC.gain_vs_baseline(m, keys=REGION))


@register(
    "winner_previous_week",
    O.build(
        f"SELECT region, year, {rsql('mae_baseline')}, {rsql('mae_model')}, n, CASE WHEN mae_model < mae_baseline THEN 'previous' ELSE 'baseline' END AS winner FROM pw",
        "bf",
        extra=[
            ("pl", _PREV_LONG),
            ("pm", "SELECT region, year, model, count(*) AS n, avg(abs(p - y)) AS mae FROM pl GROUP BY ALL HAVING count(*) >= 10"),
            ("pw", "SELECT region, year, max(mae) FILTER (model = 'baseline') AS mae_baseline, max(mae) FILTER (model = 'previous') AS mae_model, max(n) AS n FROM pm GROUP BY ALL"),
        ],
    ),
)
def q_winner_previous_week(spark, d):
    by_year = FC.metrics_by_year(_baseline_preds(spark, d), _PREVIOUS, real="incidence", keys=REGION)
    return rounded(FC.winner_by_year(by_year, "previous", keys=REGION).drop("r2_model"))


# ------------------------------------------------------------------ forest (rows-only checks)
@V.memo
def _walk_forward(spark, d):
    """Two forests per place and test week, kept as a table that the metrics keys read."""
    path = scratch_path(spark, "walk-forward")
    walk_forward_weekly(model_frame(spark, d), "incidence", CLIMATE_FEATURES, FULL_FEATURES, REGION).write.parquet(path)
    return spark.read.parquet(path)


_MODELS = {"baseline": "pred_baseline", "rf_climate": "pred_rf_climate", "rf_full": "pred_rf_full"}


@register("walk_forward_rf")
def q_walk_forward_rf(spark, d):
    """Walk-forward per place, refit every week: baseline vs forest (climate) vs forest
    (climate + AR)."""
    return rounded(_walk_forward(spark, d))


@register("walk_forward_pooled")
def q_walk_forward_pooled(spark, d):
    """The same with MLlib forests on all places pooled, refit once a year."""
    return rounded(FC.walk_forward_rf(model_frame(spark, d), "incidence", CLIMATE_FEATURES, FULL_FEATURES, REGION, refit_every=POOLED_REFIT_EVERY))


@register("gain_vs_baseline")
def q_gain_vs_baseline(spark, d):
    preds = _walk_forward(spark, d)
    m = FC.forecast_metrics(preds, _MODELS, keys=REGION)
    return rounded(FC.gain_vs_baseline(m, keys=REGION))


# one tree of two levels on every week once, with exact sums: SQL can grow the same one
TREE = {"num_trees": 1, "max_depth": 2, "min_leaf": OT.MIN_LEAF, "bootstrap": False, "digits": 6}


@register(
    "walk_forward_tree",
    O.build(
        f"SELECT b.region, b.year, b.week, {rsql('b.incidence', alias='real')}, {rsql('b.pred_baseline')}, {O.rnd('c.pred', 9)} AS pred_tree_climate, {O.rnd('a.pred', 9)} AS pred_tree_full "
        "FROM bf b JOIN tc c ON c.region = b.region AND c.row_no = b.row_no JOIN ta a ON a.region = b.region AND a.row_no = b.row_no",
        "bf",
        extra=[*OT.walk_forward_ctes("tc", CLIMATE_FEATURES, 2), *OT.walk_forward_ctes("ta", FULL_FEATURES, 2)],
    ),
)
def q_walk_forward_tree(spark, d):
    """Walk-forward per place, refit every week, with a single tree: exactly checkable."""
    found = walk_forward_weekly(model_frame(spark, d), "incidence", CLIMATE_FEATURES, FULL_FEATURES, REGION, forest=TREE)
    found = found.withColumnsRenamed({"pred_rf_climate": "pred_tree_climate", "pred_rf_full": "pred_tree_full"})
    return rounded(found, {"pred_tree_climate": 9, "pred_tree_full": 9})


@register("feature_importance")
def q_feature_importance(spark, d):
    """Importances of the final forest of each place."""
    return rounded(forest_importance(model_frame(spark, d), "incidence", FULL_FEATURES, REGION))


@register(
    "importance_tree",
    O.build(
        f"SELECT region, [{', '.join(repr(c) for c in FULL_FEATURES)}][f] AS feature, {rsql('importance')} FROM imp",
        "model",
        extra=OT.importance_ctes("imp", FULL_FEATURES, 2),
    ),
)
def q_importance_tree(spark, d):
    """Importances of one tree per place: exactly checkable."""
    return rounded(forest_importance(model_frame(spark, d), "incidence", FULL_FEATURES, REGION, forest=TREE))


@register("importance_pooled")
def q_importance_pooled(spark, d):
    """Importances of one MLlib forest on all places."""
    return rounded(FC.feature_importance(model_frame(spark, d), "incidence", FULL_FEATURES))


@register("winner_by_year")
def q_winner_by_year(spark, d):
    preds = _walk_forward(spark, d)
    by_year = FC.metrics_by_year(preds, _MODELS, keys=REGION)
    return rounded(FC.winner_by_year(by_year, "rf_full", keys=REGION))
