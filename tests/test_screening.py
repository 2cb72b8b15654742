import numpy as np
import pytest
from pyspark.sql import functions as F

from lagframe.operators import screening as S


@pytest.fixture
def frame(spark):
    rng = np.random.default_rng(7)
    n = 120
    z = rng.normal(size=n)
    x = 0.7 * z + rng.normal(scale=0.5, size=n)
    w = rng.normal(size=n)
    y = 0.5 * x + 0.3 * z + rng.normal(scale=0.5, size=n)
    years = np.repeat([2020, 2021, 2022], 40)
    pdf = [(int(yr), float(a), float(b), float(c), float(d)) for yr, a, b, c, d in zip(years, x, y, z, w)]
    return spark.createDataFrame(pdf, "year int, x double, y double, z double, w double"), np.vstack([x, y, z, w])


def _resid_corr(x, y, z):
    bx = np.polyfit(z, x, 1)
    by = np.polyfit(z, y, 1)
    return np.corrcoef(x - np.polyval(bx, z), y - np.polyval(by, z))[0, 1]


def test_partial_corr_equals_residual_method(spark, frame):
    df, (x, y, z, _) = frame
    r = S.partial_corr(df, "x", "y", "z").first()
    assert r.r_partial == pytest.approx(_resid_corr(x, y, z), abs=1e-10)
    assert r.n == 120 and 0 <= r.p_value <= 1


def test_partial_corr_small_n(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, 5.0), (3.0, 4.0, 4.0), (4.0, 3.0, 1.0)], "x double, y double, z double")
    assert S.partial_corr(df, "x", "y", "z").first().r_partial is None


def test_partial_table_pairs(spark, frame):
    df, (x, y, z, w) = frame
    t = {(r.variable, r.control): r for r in S.partial_table(df, "y", {"x": "x", "z": "z", "w": "w"}, [("x", "z"), ("z", "x"), ("w", "x")]).collect()}
    assert t[("x", "z")].r_partial == pytest.approx(_resid_corr(x, y, z), abs=1e-10)
    assert t[("z", "x")].r_partial == pytest.approx(_resid_corr(z, y, x), abs=1e-10)
    assert t[("x", "z")].significant is True


def test_vif_matches_ols(spark, frame):
    df, (x, y, z, w) = frame
    cols = np.vstack([x, z, w])

    def ols_vif(i):
        yv = cols[i]
        X = np.column_stack([np.ones(cols.shape[1])] + [cols[j] for j in range(3) if j != i])
        beta = np.linalg.lstsq(X, yv, rcond=None)[0]
        r2 = 1 - ((yv - X @ beta) ** 2).sum() / ((yv - yv.mean()) ** 2).sum()
        return round(1 / (1 - r2), 2)

    got = {r.variable: r.vif for r in S.vif(df, ["x", "z", "w"]).collect()}
    assert got == {"x": ols_vif(0), "z": ols_vif(1), "w": ols_vif(2)}
    keyed = S.vif(df.withColumn("place", F.lit("p")), ["x", "z", "w"], keys="place").collect()
    assert {r.variable: r.vif for r in keyed} == got and {r.place for r in keyed} == {"p"}


def test_vif_constant_and_single(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(i % 3)) for i in range(10)], "a double, c double, b double")
    got = {r.variable: r.vif for r in S.vif(df, ["a", "c", "b"]).collect()}
    assert got["c"] == 1.0
    assert {r.variable: r.vif for r in S.vif(df, ["a"]).collect()} == {"a": 1.0}
    status = {r.variable: r.status for r in S.vif(df, ["a", "c"]).collect()}
    assert status == {"a": "ok", "c": "ok"}


def test_zscore_sample_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, k double")
    got = [(r.z_a, r.z_k) for r in S.zscore(df, ["a", "k"]).orderBy("a").collect()]
    assert [g[0] for g in got] == [pytest.approx(-1.0), pytest.approx(0.0), pytest.approx(1.0)]
    assert all(g[1] is None for g in got)


def test_best_lag_ties_and_nulls(spark):
    m = spark.createDataFrame(
        [("v", "pearson", 0, 0.5), ("v", "pearson", 3, -0.5), ("v", "pearson", 5, None), ("u", "pearson", 1, None), ("u", "pearson", 2, None)],
        "variable string, method string, lag int, r double",
    )
    got = {r.variable: (r.lag, r.r) for r in S.best_lag(m).collect()}
    assert got == {"v": (0, 0.5), "u": (1, None)}


def test_yearly_stability_min_n(spark, frame):
    df, _ = frame
    out = S.yearly_stability(df, "y", {"x": "x"}, min_n=41)
    assert out.count() == 0
    assert S.yearly_stability(df, "y", {"x": "x"}, min_n=10).count() == 3


def test_recommend_features(spark, frame):
    df, _ = frame
    t = S.partial_table(df, "y", {"x": "x", "z": "z", "w": "w"}, [("x", "z"), ("w", "x")])
    assert [r.variable for r in S.recommend_features(t).collect()] == ["x"]


def test_vif_collinear_and_infinite(spark):
    rows = [(float(i), 3.0 * i + 1.0, float(i * i % 7), 5.0, float(i % 3) + float(i * i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, d double")
    got = {r.variable: (r.vif, r.status) for r in S.vif(df, ["a", "b", "c", "k"]).collect()}
    assert got["a"] == got["b"] == (float("inf"), "high") and got["k"] == (1.0, "ok") and got["c"][0] < 2
    three = df.withColumn("e", F.col("c") + F.col("d"))  # one of three determines the others
    assert {r.vif for r in S.vif(three, ["c", "d", "e"]).collect()} == {float("inf")}
    bad = df.withColumn("a", F.when(F.col("a") == 3.0, F.lit(float("inf"))).otherwise(F.col("a")))
    assert {r.variable: r.vif for r in S.vif(bad, ["a", "c", "k"]).collect()}["a"] is None
    assert [tuple(r) for r in S.partial_corr(bad, "a", "c", "d").select("r_partial", "p_value").collect()] == [(None, None)]
