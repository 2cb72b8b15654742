"""Ranks, correlations, quantiles, z-scores and as-of lookups over groups of any size."""

import datetime as dt
import io
import random
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagframe.operators import correlation as C
from lagframe.operators import quantiles as Q
from lagframe.operators import screening as S
from lagframe.operators.asof import asof_backward
from lagframe.operators.frames import describe
from lagframe.operators.ranks import average_ranks


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def wide(spark):
    """Rows with ties, nulls, NaN and a null group, over several partitions."""
    r = random.Random(1)
    rows = [(g, float(r.randrange(40)) if g != "b" else r.gauss(0, 1), r.choice([None, float("nan"), r.gauss(5, 2), 1.0, float(r.randrange(9))])) for g in ["a"] * 300 + ["b"] * 300 + [None] * 50 + ["few"] * 2]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "g string, x double, y double").repartition(5).withColumn("id", F.monotonically_increasing_id())


def test_average_ranks_equal_pandas(wide):
    pdf = wide.toPandas().sort_values("id")
    got = average_ranks(wide, "y", ["g"]).toPandas().sort_values("id")
    assert np.allclose(got["rank"].to_numpy(), pdf.groupby("g", dropna=False)["y"].rank(method="average").to_numpy(), equal_nan=True)
    whole = average_ranks(wide, "x").toPandas().sort_values("id")
    assert np.allclose(whole["rank"].to_numpy(), pdf["x"].rank(method="average").to_numpy(), equal_nan=True)


def test_ranks_hold_no_whole_group_in_a_task(spark):
    """One group of distinct values: dealt by range, no range holds much more than its share."""
    df = spark.range(0, 40_000, 1, 6).select((F.xxhash64("id") % 1_000_003).cast("double").alias("x"))
    dealt = df.distinct().repartitionByRange(8, "x").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert dealt.max() < 2 * dealt.median()
    ranked = average_ranks(df, "x", [], "r")
    text = plan(ranked)
    assert "Window" not in text  # the counting ran by ranges; what is left is a join
    assert ranked.agg(F.sum("r")).first()[0] == 40_000 * 40_001 / 2


@pytest.mark.parametrize("methods,groups", [(("pearson", "spearman"), (["g"],)), (("pearson",), (["g"], [])), (("spearman",), ([],))])
def test_strategies_agree(wide, methods, groups):
    for group in groups:
        got = {s: {tuple(x[c] for c in (*group, "method")): (x.r, x.p_value, x.n) for x in C.pair_stats(wide, "x", "y", group, methods, rank_strategy=s).collect()} for s in ("ranged", "collapsed", "window")}
        assert set(got["ranged"]) == set(got["window"]) == set(got["collapsed"])
        for key, (r, p, n) in got["window"].items():
            for s in ("ranged", "collapsed"):
                assert got[s][key][2] == n
                assert got[s][key][:2] == ((None, None) if r is None else (pytest.approx(r, abs=1e-11), pytest.approx(p, abs=1e-9)))


def test_pearson_merges_without_a_window_and_keeps_digits(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=5000)
    y = 0.3 * x + rng.normal(size=5000)
    fx, fy = np.round(x, 3) + 1e9, np.round(y, 3) - 2e9
    df = spark.createDataFrame(pd.DataFrame({"g": ["a", "b"] * 2500, "x": fx, "y": fy})).repartition(7)
    out = C.pair_stats(df, "x", "y", ["g"], ["pearson"])
    assert "Window" not in plan(out)
    got = {r.g: r.r for r in out.collect()}
    for i, g in enumerate("ab"):
        want = np.corrcoef((fx - 1e9)[i::2], (fy + 2e9)[i::2])[0, 1]
        assert got[g] == pytest.approx(want, abs=1e-12)


def test_quantiles_refine_to_exact_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "GATHER", 20)
    monkeypatch.setattr(Q, "BINS", 64)
    r = random.Random(4)
    data = {
        "even": [float(i) for i in range(500)],
        "far": [10.0 ** r.uniform(-3, 4) * r.choice([1, -1]) for _ in range(300)] + [1e300],
        "ties": [float(r.choice([1, 2, 2, 2, 3])) for _ in range(400)],
        "one": [3.5],
        "two": [1.0, 2.0],
        "tiny": [5e-324 * r.randrange(5) for _ in range(50)],
        "edges": [float("inf"), float("-inf"), 1.7e308, -1.7e308, 0.0, 1.0, 2.0, 3.0, 4.0],
        None: [float(r.randrange(1000)) for _ in range(200)],
    }
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("one", None), ("two", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    names = ["q0", "q25", "q50", "q99", "q100"]
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {x[0]: list(x[1:]) for x in Q.exact_quantiles(df, "x", ["g"], shares, names).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        if g == "edges":
            assert got[g][1:3] == [0.0, 2.0] and got[g][4] == float("inf")
        else:
            assert got[g] == pytest.approx([float(np.quantile(vs, s)) for s in shares], rel=1e-12)


def test_describe_equals_pandas(wide):
    pdf = wide.toPandas()
    got = {(r.g, r.variable): r for r in describe(wide, ["x", "y"], "g").collect()}
    for g, part in pdf.groupby("g", dropna=False):
        g = None if pd.isna(g) else g
        for c in ("x", "y"):
            want, r = part[c].describe(), got[(g, c)]
            assert r["count"] == want["count"]
            for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert (r[mine] is None and np.isnan(want[theirs])) or r[mine] == pytest.approx(want[theirs], abs=1e-9)
    assert "percentile" not in plan(describe(wide, ["x"], "g"))


def test_zscore_without_keys_has_no_window(wide):
    z = S.zscore(wide, ["x", "y"])
    text = plan(z)
    assert "Window" not in text and "NestedLoop" not in text and "Cartesian" not in text
    pdf = z.toPandas()
    for c in ("x", "y"):
        assert np.allclose(pdf[f"z_{c}"], (pdf[c] - pdf[c].mean()) / pdf[c].std(), equal_nan=True)


def test_vif_runs_without_python(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), float(i % 5)) for i in range(30)], "a double, b double, c double")
    text = plan(S.vif(df, ["a", "b", "c"]))
    assert "MapIn" not in text and "EvalPython" not in text and "FlatMapGroups" not in text


def test_asof_backward_equals_pandas(spark):
    r = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    obs = [(r.choice("abc"), t0 + dt.timedelta(minutes=r.randrange(3000)), r.random()) for _ in range(300)]
    obs = list({(k, t): (k, t, v) for k, t, v in obs}.values())
    asked = [(i, r.choice("abcd"), t0 + dt.timedelta(minutes=r.randrange(-50, 3000))) for i in range(400)] + [(900, "a", obs[0][1]), (901, None, t0), (902, "a", None)]
    o = spark.createDataFrame([*obs, ("a", None, 9.0)], "k string, t timestamp_ntz, v double").repartition(3)
    q = spark.createDataFrame(asked, "id int, k string, t timestamp_ntz").repartition(4)
    got = {x.id: (x.v_asof, x.t_asof) for x in asof_backward(q, o, "t", ["v"], "k").collect()}
    near = {x.id: x.v_asof for x in asof_backward(q, o, "t", ["v"], "k", tolerance=F.expr("INTERVAL 30 MINUTES")).collect()}
    assert len(got) == len(asked)
    for i, k, t in asked:
        before = [] if t is None else [x for x in obs if x[0] == k and x[1] <= t]
        last = max(before, key=lambda x: x[1]) if before else (None, None, None)
        assert got[i] == (last[2], last[1])
        assert near[i] == (last[2] if last[1] and last[1] >= t - dt.timedelta(minutes=30) else None)


def test_asof_of_one_entity_over_many_ranges(spark):
    """A long history of one entity: requests find their observation across ranges."""
    o = spark.range(0, 20_000, 100).select(F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    q = spark.range(0, 20_000).select(F.col("id").alias("t"))
    wrong = asof_backward(q, o, "t", ["v"]).filter("v_asof <> 2 * (t - t % 100) or v_asof is null")
    assert wrong.count() == 0
    assert asof_backward(q, o.limit(0), "t", ["v"]).filter("v_asof is not null").count() == 0
    assert asof_backward(q.limit(0), o, "t", ["v"]).count() == 0
