"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key,
each paired (where SQL can express it) with an independent DuckDB oracle.

Doubles are rounded at the output only (6 decimals by default, 9 for p-values,
2 for sums of large values) so both engines hash to the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import correlation as C
from ..operators import lagjoin as LJ
from . import oracle as O
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ndvi = mean of integer DNs over a few pixels / 10000: its decimal expansion often ends
# at the 7th digit on a 5, a rounding half at 6 digits; at 10 digits it never is.
# r2 of exact-fraction incidences can end on such a half too; being O(1) it keeps
# ~15 exact digits, so 10 is safe (unlike sums, whose last digits carry order noise).
DIGITS = {"p_value": 9, "price_sum": 2, "ndvi": 10, "r2": 10}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def rounded(df: DataFrame, digits: dict | None = None, default: int = 6) -> DataFrame:
    """Output normalisation: round every double column (-0.0 becomes 0.0) and
    render dates as ISO 'yyyy-MM-dd' strings so both engines hash them alike."""
    spec = dict(DIGITS)
    spec.update(digits or {})
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = spec.get(f.name)
            if d is None:
                d = next((v for k, v in spec.items() if f.name.startswith(k + "_lag")), default)
            out.append((F.round(F.col(f.name).cast("double"), d) + 0.0).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rsql(expr: str, digits: int | None = None, alias: str | None = None) -> str:
    """Rounded SQL select item; the alias defaults to the column name after any 't.' prefix."""
    alias = alias or expr.split(".")[-1]
    if digits is None:
        digits = DIGITS.get(alias)
        if digits is None:
            digits = next((v for k, v in DIGITS.items() if alias.startswith(k + "_lag")), 6)
    return f"{O.rnd(expr, digits)} AS {alias}"


def dsql(expr: str, alias: str | None = None) -> str:
    """Date select item rendered as an ISO string (matches ``rounded``)."""
    alias = alias or expr.split(".")[-1]
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {alias}"


REGION = ["region"]
LAGS = list(range(0, 9))

# ================================================================== E1 weekly roll-up
_WEEKLY_COLS = ["region", "year", "week", *V.DAILY_VARS, "valid_days"]


@register(
    "weekly_rollup",
    O.build(
        "SELECT region, year, week, "
        + ", ".join(rsql(c) for c in V.DAILY_VARS)
        + ", valid_days FROM weekly",
        "weekly",
    ),
)
def q_weekly_rollup(spark, d):
    """The roll-up itself: always computed from the raw line items."""
    return rounded(V.weekly(spark, d).select(*_WEEKLY_COLS))


# ================================================================== D1 lag join
_CASE_COLS = ["geocode", "region", "se", "year", "week", "cases", "cases_est", "incidence", "level"]
_LAG4_COLS = [f"{c}_lag4" for c in (*V.DAILY_VARS, "valid_days")]


@register(
    "lag_join",
    O.build(
        "SELECT c.geocode, c.region, c.se, c.year, c.week, c.cases, "
        + rsql("c.cases_est")
        + ", "
        + rsql("c.incidence")
        + ", c.level, "
        + ", ".join(rsql(f"k.{c}") for c in _LAG4_COLS if not c.startswith("valid"))
        + ", k.valid_days_lag4 "
        + "FROM cases_idx c LEFT JOIN ("
        + O.lagged_sql("weekly_idx", 4, [*V.DAILY_VARS, "valid_days"], REGION)
        + ") k ON k.region = c.region AND k.tidx = c.idx",
        "cases_idx",
        "weekly_idx",
    ),
)
def q_lag_join(spark, d):
    j = LJ.lag_join(V.cases_t(spark, d), V.weekly_t(spark, d), lag=4, keys=REGION)
    return rounded(j.select(*_CASE_COLS, *_LAG4_COLS))


# ================================================================== E2-E7 correlations
def sweep_cols(with_source: bool, keys=REGION) -> list[str]:
    return [*keys, *(["source"] if with_source else []), "variable", "method", "lag"]


def _sweep_oracle(sources, lags, methods, keys=REGION, target="incidence", cases_idx="cases_idx"):
    needed, extra = O.sweep_ctes(sources, lags, methods, keys, target, cases_idx)
    cols = sweep_cols(any(s is not None for s, _, _ in sources), keys)
    sel = f"SELECT {', '.join(cols)}, {rsql('r')}, {rsql('p_value')}, n FROM mat"
    return O.build(sel, *needed, extra=extra)


def _matrix(spark, d, variables, lags, methods, sat=False):
    sources = {"climate": (V.weekly_t(spark, d), list(variables))}
    if sat:
        sources["satellite"] = (V.sat_weekly_t(spark, d), list(V.SAT_VARS))
    else:
        sources = {None: sources["climate"]}
    out = C.corr_sweep(V.cases_t(spark, d), sources, lags=lags, target="incidence", methods=methods, keys=REGION)
    return rounded(out)


@register("corr_pearson", _sweep_oracle([(None, "weekly_idx", V.DAILY_VARS)], [8], ["pearson"]))
def q_corr_pearson(spark, d):
    """Minimum slice: roll-up -> lag join (lag 8) -> Pearson per region and variable."""
    return _matrix(spark, d, V.DAILY_VARS, [8], ["pearson"])


@register("corr_spearman", _sweep_oracle([(None, "weekly_idx", V.DAILY_VARS)], [8], ["spearman"]))
def q_corr_spearman(spark, d):
    return _matrix(spark, d, V.DAILY_VARS, [8], ["spearman"])


@register("lag_sweep", _sweep_oracle([(None, "weekly_idx", ["qty_min"])], LAGS, ["pearson", "spearman"]))
def q_lag_sweep(spark, d):
    return rounded(C.lag_sweep(V.cases_t(spark, d), V.weekly_t(spark, d), "qty_min", LAGS, "incidence", keys=REGION))


@register("corr_matrix", _sweep_oracle([(None, "weekly_idx", V.DAILY_VARS)], LAGS, ["pearson", "spearman"]))
def q_corr_matrix(spark, d):
    """Flagship: 5 variables x 9 lags x 2 methods per region, one job."""
    return _matrix(spark, d, V.DAILY_VARS, LAGS, ["pearson", "spearman"])


@register(
    "corr_pvalue",
    _sweep_oracle([(None, "weekly_all_idx", V.DAILY_VARS)], LAGS, ["pearson", "spearman"], keys=[], cases_idx="cases_all_idx"),
)
def q_corr_pvalue(spark, d):
    """Single-series mode (no entity, as the original runs): r, p and n for the whole matrix."""
    out = C.corr_matrix(V.cases_all_t(spark, d), V.weekly_all_t(spark, d), V.DAILY_VARS, LAGS, "incidence")
    return rounded(out)


@register(
    "corr_matrix_sources",
    _sweep_oracle(
        [("climate", "weekly_idx", V.DAILY_VARS), ("satellite", "sat_weekly_idx", V.SAT_VARS)],
        LAGS,
        ["pearson", "spearman"],
    ),
)
def q_corr_matrix_sources(spark, d):
    return _matrix(spark, d, V.DAILY_VARS, LAGS, ["pearson", "spearman"], sat=True)
