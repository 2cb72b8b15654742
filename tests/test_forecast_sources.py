import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagframe.operators import forecast as FC
from lagframe.operators.frames import date_range, describe, outbreak_flag
from lagframe.session import scratch_path
from lagframe.sources import landed as L
from lagframe.sources.tables import Store, dedup_latest
from lagframe.sources.zones import validate_points, zone_lookup


@pytest.fixture
def series(spark):
    y = [float(v) for v in [5, 7, 6, 9, 12, 10, 0, 4, 8, 11, 13, 9]]
    return spark.createDataFrame([("a", 2024, i + 1, v) for i, v in enumerate(y)], "place string, year int, week int, y double"), y


def test_autoreg_and_baseline(spark, series):
    df, y = series
    out = FC.baseline_forecast(FC.autoreg_features(df, "y", [1, 2], ["place"], prefix="y_lag"), "y", 4, ["place"]).orderBy("week").collect()
    assert out[0].y_lag1 is None and out[2].y_lag1 == y[1] and out[2].y_lag2 == y[0]
    assert out[0].pred_baseline is None
    assert out[5].pred_baseline == pytest.approx(np.mean(y[1:5]))


def test_autoreg_calendar_mode_skips_gaps(spark):
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, 2.0), (2024, 4, 4.0)], "year int, week int, y double")
    out = {r.week: r.y_lag1 for r in FC.autoreg_features(df, "y", [1], mode="calendar", prefix="y_lag").collect()}
    assert out == {1: None, 2: 1.0, 4: None}


def test_baseline_calendar_mode(spark):
    df = spark.createDataFrame([(2024, 1, 2.0), (2024, 2, 4.0), (2024, 5, 10.0), (2024, 6, 0.0)], "year int, week int, y double")
    pos = {r.week: r.pred_baseline for r in FC.baseline_forecast(df, "y", 2).collect()}
    cal_ = {r.week: r.pred_baseline for r in FC.baseline_forecast(df, "y", 2, mode="calendar").collect()}
    assert pos[5] == 3.0 and cal_[5] is None  # weeks 3-4 are missing
    assert pos[6] == 7.0 and cal_[6] == 10.0


def test_folds(spark, series):
    df, _ = series
    out = FC.walk_forward_folds(df, ["place"], min_train=10).orderBy("week").collect()
    assert [r.is_test for r in out] == [False] * 10 + [True] * 2


def test_metrics_match_numpy(spark):
    y = np.array([10.0, 0.0, 5.0, 8.0])
    p = np.array([12.0, 1.0, 5.0, 4.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "real double, pred double")
    m = FC.forecast_metrics(df, {"m": "pred"}).first()
    e = p - y
    assert m.mae == pytest.approx(np.abs(e).mean())
    assert m.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert m.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    mask = y > 0
    assert m.mape == pytest.approx(np.mean(np.abs(e[mask] / y[mask])) * 100)
    g = FC.gain_vs_baseline(FC.forecast_metrics(df.withColumn("bl", F.col("real") + 4.0), {"m": "pred", "baseline": "bl"}))
    gains = {r.model: r.gain_pct for r in g.collect()}
    assert gains["baseline"] == pytest.approx(0.0) and gains["m"] == pytest.approx((1 - np.abs(e).mean() / 4.0) * 100)


def test_metrics_constant_actuals(spark):
    df = spark.createDataFrame([(3.0, 2.0, 3.0), (3.0, 4.0, 3.0)], "real double, pred double, perfect double")
    got = {r.model: r.r2 for r in FC.forecast_metrics(df, {"m": "pred", "p": "perfect"}).collect()}
    assert got == {"m": 0.0, "p": 1.0}
    assert FC.forecast_metrics(df, {"m": "pred"}, constant_r2="null").first().r2 is None


def test_walk_forward_forest_invariants(spark):
    rng = np.random.default_rng(1)
    rows = []
    for place in ("a", "b"):
        for w in range(1, 31):
            x = float(rng.normal())
            rows.append((place, 2024, w, x, float(max(0.0, 3 + 2 * x + rng.normal(scale=0.1)))))
    df = spark.createDataFrame(rows, "place string, year int, week int, x double, y double")
    df = FC.autoreg_features(df, "y", [1], ["place"], prefix="y_lag").dropna()
    out = FC.walk_forward_rf(df, "y", ["x"], ["x", "y_lag1"], ["place"], min_train=20, refit_every=5, forest={"num_trees": 10, "max_depth": 3, "min_leaf": 1})
    got = out.collect()
    assert len(got) == 2 * (29 - 20)
    assert all(r.pred_rf_climate >= 0 and r.pred_rf_full >= 0 for r in got)
    imp = FC.feature_importance(df, "y", ["x", "y_lag1"], forest={"num_trees": 10, "max_depth": 3, "min_leaf": 1}).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0) and imp[0].importance >= imp[1].importance


def _cart(x, y, row, depth, leaf):
    """Mean of the leaf that `row` falls into, by exhaustive search."""
    n, best, chosen = len(y), y.sum() ** 2 / len(y) + 1e-9 * (1 + y.sum() ** 2 / len(y)), None
    for f in range(x.shape[1]) if depth else ():
        o = np.argsort(x[:, f], kind="stable")
        v, c = x[o, f], np.cumsum(y[o])
        for i in range(leaf - 1, n - leaf):
            score = c[i] ** 2 / (i + 1) + (c[-1] - c[i]) ** 2 / (n - i - 1)
            if v[i] < v[i + 1] and score > best:
                best, chosen = score, (f, (v[i] + v[i + 1]) / 2)
    if chosen is None:
        return y.mean()
    side = x[:, chosen[0]] > chosen[1]
    side = side if row[chosen[0]] > chosen[1] else ~side
    return _cart(x[side], y[side], row, depth - 1, leaf)


def test_grown_trees_match_exhaustive_search():
    from lagframe.operators.weekly_forest import forest_grower

    (predict, _), rng = forest_grower(), np.random.default_rng(2)
    for _ in range(25):
        n = int(rng.integers(10, 90))
        x = np.column_stack([np.round(rng.normal(size=n), 1), rng.normal(size=n)])  # repeated values, but no tied cuts
        y, row = rng.normal(size=n) + 2 * x[:, 0], rng.normal(size=2)
        orders = [np.argsort(x[:, f], kind="stable") for f in range(2)]
        assert predict(x, y, orders, row, np.stack([np.arange(n)] * 2), 5, 6) == pytest.approx(_cart(x, y, row, 5, 6), abs=1e-9)
        draw = rng.integers(0, n, (7, n))
        one_by_one = [predict(x, y, orders, row, d[None, :], 5, 6) for d in draw]
        assert predict(x, y, orders, row, draw, 5, 6) == pytest.approx(np.mean(one_by_one), abs=1e-9)


def _drops(x, y, w, rows, depth, leaf, out):
    """Add the drops of squared error of a weighted tree, by exhaustive search, to ``out``."""
    if not depth:
        return
    whole = (w[rows] * y[rows]).sum() ** 2 / w[rows].sum()
    best, chosen = whole + 1e-9 * (1 + abs(whole)), None
    for f in range(x.shape[1]):
        for v, nv in zip(u := np.unique(x[rows, f]), u[1:]):
            left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
            if min(len(left), len(right)) >= leaf:
                score = sum((w[r] * y[r]).sum() ** 2 / w[r].sum() for r in (left, right))
                if score > best:
                    best, chosen = score, (f, (v + nv) / 2)
    if chosen:
        out[chosen[0]] += best - whole
        side = x[rows, chosen[0]] > chosen[1]
        _drops(x, y, w, rows[~side], depth - 1, leaf, out)
        _drops(x, y, w, rows[side], depth - 1, leaf, out)


def test_importances_equal_exhaustive_search(spark):
    """200 trees over two series, whatever the dealing, against trees grown one by one."""
    from lagframe.operators.weekly_forest import forest_importance

    rng = np.random.default_rng(7)
    data, rows = {}, []
    for place in ("a", "b"):
        x = np.column_stack([rng.normal(size=40), rng.normal(size=40), rng.normal(size=40)])
        y = 2 * x[:, 0] - x[:, 1] + rng.normal(scale=0.3, size=40)
        data[place] = (x, np.round(y * 1e6))  # sums are exact in units of the sixth decimal
        rows += [(place, 2024, w + 1, *map(float, x[w]), float(y[w])) for w in range(40)]
    rows += [("c", 2024, w, 1.0, 1.0, 1.0, float(w)) for w in range(1, 9)]
    df = spark.createDataFrame(rows, "place string, year int, week int, u double, v double, z double, y double")
    run = {"num_trees": 200, "max_depth": 3, "min_leaf": 3}
    got = forest_importance(df, "y", ["u", "v", "z"], ["place"], forest=run).collect()
    again = forest_importance(df, "y", ["u", "v", "z"], ["place"], forest=run, chunks=3).collect()
    assert {(r.place, r.feature): r.importance for r in again} == pytest.approx({(r.place, r.feature): r.importance for r in got}, abs=1e-12)
    for place, (x, y) in data.items():
        shares = []
        for t in range(200):
            w = np.bincount(np.random.default_rng([42, t]).integers(0, 40, 40), minlength=40).astype(float)
            out = np.zeros(3)
            _drops(x, y, w, np.flatnonzero(w), 3, 3, out)
            shares.append(out / out.sum())
        want = dict(zip(("u", "v", "z"), np.mean(shares, axis=0)))
        mine = [(r.feature, r.importance) for r in got if r.place == place]
        assert dict(mine) == pytest.approx(want, abs=1e-9) and mine == sorted(mine, key=lambda r: -r[1])
    assert {r.importance for r in got if r.place == "c"} == {None}


def test_weekly_walk_forward(spark):
    from lagframe.operators.weekly_forest import walk_forward_weekly

    rng = np.random.default_rng(4)
    rows = []
    for place in ("a", "b", "short"):
        for w in range(1, 6 if place == "short" else 31):
            x = float(rng.normal())
            rows.append((place, 2024, w, x, None if w == 3 else float(max(0.0, 3 + 2 * x + rng.normal(scale=0.1)))))
    df = spark.createDataFrame(rows, "place string, year int, week int, x double, y double")
    df = FC.autoreg_features(df, "y", [1], ["place"], prefix="y_lag")
    run = {"num_trees": 30, "max_depth": 4, "min_leaf": 2}
    got = walk_forward_weekly(df, "y", ["x"], ["x", "y_lag1"], ["place"], min_train=15, forest=run, chunks=4).toPandas()
    again = walk_forward_weekly(df, "y", ["x"], ["x", "y_lag1"], ["place"], min_train=15, forest=run, chunks=3).toPandas()
    order = ["place", "week"]
    assert got.sort_values(order, ignore_index=True).equals(again.sort_values(order, ignore_index=True))  # whatever the chunks
    assert set(got.place) == {"a", "b"} and (got.groupby("place").size() == 27 - 15).all()
    assert (got.pred_rf_full >= 0).all() and np.abs(got.pred_rf_climate - got.real).mean() < np.abs(got.pred_baseline - got.real).mean()


def test_store_appends_and_nullfill(spark):
    s = Store(spark, scratch_path(spark, "t-store"), prefix="t_", year_bounds=(2000, 2100))
    s.create_schema()
    s.create_schema()  # idempotent
    cases = spark.createDataFrame([(101, "Córdoba", 202401, 10, 12.5, 1, 2.3), (101, "Córdoba", 202402, 11, 13.5, 2, 2.5)], "geocode int, place string, se int, cases long, cases_est double, level int, incidence double")
    assert s.append_cases(cases) == 2
    got = sorted((r.year, r.week) for r in s.table("cases_raw").collect())
    assert got == [(2024, 1), (2024, 2)]
    with pytest.raises(ValueError):
        s.append_cases(cases.drop("level"))
    sat = spark.createDataFrame([(2024, 1)], "year int, week int")
    assert s.append_satellite(sat, "Córdoba") == 1
    r = s.table("weekly_satellite").first()
    assert (r.ndvi, r.lst_night_c, r.valid_days, r.place) == (None, None, None, "Córdoba")
    s.refresh("cases_raw", cases.filter("se = 202402").withColumns({"year": F.lit(2024), "week": F.lit(2)}))
    assert s.table("cases_raw").count() == 1


def test_dedup_latest(spark):
    df = spark.createDataFrame(
        [("k", 1, dt.datetime(2024, 1, 1)), ("k", 2, dt.datetime(2024, 2, 1)), ("j", 3, dt.datetime(2024, 1, 1))],
        "key string, v int, loaded_at timestamp",
    )
    assert sorted((r.key, r.v) for r in dedup_latest(df, ["key"]).collect()) == [("j", 3), ("k", 2)]


def test_landed_csv_ingest_with_rejects(spark):
    root = scratch_path(spark, "t-landed")
    df = spark.createDataFrame([(1, 2024, "202401", 3, 3.5, 1, 0.7), (1, 2024, "2024x1", 1, 1.0, 1, 0.1), (2, 2023, "202352", 5, 5.0, 2, 1.1)], "geocode int, year int, se string, cases long, cases_est double, level int, incidence double")
    L.land_case_csv(df, root)
    rows, rejects = L.ingest_case_csv(spark, root, {"A": 1, "B": 2}, 2024, 2024)
    assert [(r.place, r.year, r.week) for r in rows.collect()] == [("A", 2024, 1)]
    assert rejects.count() == 1
    with pytest.raises(ValueError):
        L.ingest_case_csv(spark, root, {"A": 1}, 2025, 2024)
    with pytest.raises(ValueError):
        L.ingest_case_csv(spark, root, {}, 2024, 2024)


def test_json_parallel_arrays(spark):
    good = {"latitude": -23.4, "longitude": -51.9, "daily": {"time": ["2024-01-01", "2024-01-02"], "t": [25.0, 26.0]}}
    short = {"daily": {"time": ["2024-01-01", "2024-01-02"], "t": [25.0]}}
    df = spark.createDataFrame([("a", json.dumps(good)), ("b", json.dumps(short)), ("c", "not json"), ("d", json.dumps({"x": 1}))], "k string, payload string")
    rows, rejects = L.explode_daily_payload(df, ["t"], keys=["k"])
    assert [(r.k, r.day, r.t) for r in rows.orderBy("day").collect()] == [("a", dt.date(2024, 1, 1), 25.0), ("a", dt.date(2024, 1, 2), 26.0)]
    assert sorted(r.k for r in rejects.collect()) == ["b", "c", "d"]


def test_zone_lookup_and_points(spark):
    zones = spark.createDataFrame([(1, "Cordoba"), (2, "Lisboa"), (3, "Cordoba")], "zone_id int, zone_name string")
    req = spark.createDataFrame([("Córdoba",), ("Nowhere",)], "name string")
    m, missing = zone_lookup(req, zones)
    r = m.first()
    assert (r.zone_id, r.n_matches) == (1, 2)
    assert [x.name for x in missing.collect()] == ["Nowhere"]
    with pytest.raises(ValueError, match="Nowhere"):
        zone_lookup(req, zones, on_missing="error")
    pts = spark.createDataFrame([(1, 10.0, 20.0), (2, 95.0, 0.0), (3, 0.0, -190.0)], "id int, latitude double, longitude double")
    assert [r.valid for r in validate_points(pts).orderBy("id").collect()] == [True, False, False]


def test_frames_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1.0), (dt.datetime(2024, 1, 31, 23), 2.0), (dt.datetime(2024, 2, 1), 3.0)], "ts timestamp_ntz, v double")
    assert date_range(df, "ts", "2024-01-01", "2024-01-31").count() == 2
    assert [r.outbreak for r in outbreak_flag(df, "v", 1.5).orderBy("v").collect()] == [False, True, True]
    d = describe(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double"), ["x"]).first()
    assert (d.p25, d.p50, d.p75) == (1.75, 2.5, 4.75)


def test_describe_approx(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)], "x double")
    d = describe(df, ["x"], exact=False).first()
    assert d["count"] == 100 and d.min == 1.0 and d.max == 100.0 and 49.0 <= d.p50 <= 51.0
