"""lagframe.operators: DataFrame operators (roll-up, lag join, correlations, screening, forecast)."""

from .correlation import corr_matrix, corr_matrix_sources, corr_sweep, correlate, lag_sweep, pair_stats
from .forecast import (
    autoreg_features,
    baseline_forecast,
    feature_importance,
    forecast_metrics,
    gain_vs_baseline,
    metrics_by_year,
    model_frame,
    walk_forward_folds,
    walk_forward_rf,
    winner_by_year,
)
from .frames import date_range, describe, outbreak_flag, table_coverage
from .lagjoin import feature_frame, join_coverage, lag_join, lag_targets
from .rollup import daily_outer, daily_spine_ffill, weekly_rollup, zonal_mean
from .screening import (
    best_lag,
    corr_pivot,
    corr_pivot_multi,
    corr_ranking,
    interaction,
    partial_corr,
    partial_table,
    recommend_features,
    vif,
    yearly_stability,
    zscore,
)

__all__ = [name for name in dir() if not name.startswith("_")]
