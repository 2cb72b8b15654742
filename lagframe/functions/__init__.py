"""lagframe.functions: native column expressions (calendars, p-values, scalars)."""

from .calendar import (
    date_to_week,
    date_to_year,
    is_valid_week,
    parse_yearweek,
    week_add_week,
    week_add_year,
    week_index,
    week_start,
    week_start_of,
)
from .pvalue import corr_pvalue, with_pvalue
from .scalars import clamp_nonneg, fold_accents, nan_to_null, normalize_nans, relabel, scale_lst, scale_ndvi

__all__ = [name for name in dir() if not name.startswith("_")]
