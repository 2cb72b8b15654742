"""A slice of the driver's gate: registered queries vs their DuckDB oracles on sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = ["weekly_rollup", "lag_join", "corr_matrix", "corr_pvalue", "partial_table", "vif", "dedup_latest", "week_add", "cdc_week", "daily_spine_ffill", "forecast_metrics"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_key_has_a_callable_and_oracles_are_a_subset():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 68 and len(o) >= 64


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF).toPandas()
    ddf = duck.execute(E.oracle_sql()[key]).df()
    sc, sr = _rows(sdf)
    dc, dr = _rows(ddf)
    assert sc == dc
    assert len(sr) == len(dr) > 0
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "variable", "method", "lag", "r", "p_value", "n"]
    assert df.count() > 0
