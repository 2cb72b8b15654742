"""op2 and op4 against brute force, with odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagframe.llm.lsh import multiprobe_neighbours
from lagframe.llm.topk import histogram_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, query_id string, score string"


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, None, "x", "x", "x") for i, v in rows], SCHEMA)

    return make


def sample(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1)[:, None]


ODD = [(None, [1.0, 0.0]), (1001, None), (1050, [float("nan")] * 16), (1100, [1.0, None]), (1150, [float("inf")] * 16)]


def test_top_k_matches_brute_force(vectors):
    x = sample(600, 16, 1)
    x[300:420] = x[0]  # one very common vector: ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[5].tolist())] + ODD
    got = {tuple(r) for r in histogram_top_k(vectors(rows), F.col("vec_id") % 50 == 0, k=5, query_group=4, candidate_group=100, bins=8).collect()}
    z = np.floor(256 * x.astype(float)).astype(np.int64)
    want = set()
    for i in range(0, 600, 50):
        s = z @ z[i]
        best = [j for j in np.lexsort((np.arange(600), -s)) if j != i][:5]
        want |= {(i, r + 1, int(j), int(s[j])) for r, j in enumerate(best)}
    assert got == want


def test_top_k_few_candidates_and_large_values(vectors):
    got = histogram_top_k(vectors([(0, [3.0e6, 1.0]), (1, [3.0e6, -1.0]), (2, [0.0, 0.0])]), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 1, 1, (256 * 3000000) ** 2 - 256 * 256), (0, 2, 2, 0)]
    assert histogram_top_k(vectors([]), F.col("vec_id") % 50 == 0).count() == 0
    assert histogram_top_k(vectors([(0, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("scaled", [False, True])
def test_lsh_recall_and_scores(vectors, scaled):
    x = sample(3000, 24, 2)
    if scaled:
        x *= np.random.default_rng(3).uniform(0.5, 2.0, (len(x), 1)).astype(np.float32)
    x[2000:2200] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(4020, [0.0] * 24)] + ODD
    got = multiprobe_neighbours(vectors(rows), F.col("vec_id") % 20 == 0, k=20, group=500).toPandas()
    x = x.astype(float)
    hit = 0
    for i in range(0, 3000, 20):
        s = x @ x[i]
        best = [j for j in np.lexsort((np.arange(3000), -s)) if j != i][:20]
        mine = got[got.query_id == i].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine.score, s[mine.vec_id], rtol=0, atol=1e-12)
        assert mine.score.is_monotonic_decreasing and i not in set(mine.vec_id)
        hit += len(set(best) & set(mine.vec_id))
    assert hit >= 0.9 * 20 * 150 and len(got) == 20 * 150


def test_lsh_returns_all_of_few(vectors):
    x = sample(12, 8, 4)
    got = multiprobe_neighbours(vectors([(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % 20 == 0).collect()
    s = x.astype(float) @ x[0].astype(float)
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [j for j in np.lexsort((np.arange(12), -s)) if j != 0]
    assert multiprobe_neighbours(vectors([]), F.col("vec_id") % 20 == 0).count() == 0
    assert multiprobe_neighbours(vectors([(0, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert multiprobe_neighbours(vectors([(0, [1.0, 2.0]), (1, [1.0])]), F.col("vec_id") % 20 == 0).count() == 1


@pytest.mark.parametrize("norms", ["one long", "log-normal"])
def test_lsh_recall_with_uneven_norms(vectors, norms):
    x = sample(20000, 64, 5).astype(float)
    if norms == "one long":
        x[7] *= 10
    else:
        x *= np.random.default_rng(6).lognormal(0, 1, (len(x), 1))
    x = x.astype(np.float32)
    got = multiprobe_neighbours(vectors([(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % 100 == 0, k=20).toPandas()
    x = x.astype(float)
    hit = 0
    for i, mine in got.groupby("query_id"):
        s = x @ x[i]
        s[i] = -np.inf
        hit += len(set(np.argsort(-s)[:20].tolist()) & set(mine.vec_id))
    assert len(got) == 20 * 200 and hit >= 0.9 * 20 * 200, hit / 4000


@pytest.mark.parametrize("copies,dim", [(101, 64), (400, 100)])
def test_lsh_ties_go_to_the_smaller_id(vectors, copies, dim):
    """Equal vectors have one score wherever they lie, so their ids decide; rerun in another
    dealing the answer is the same."""
    x = sample(600, dim, 7)
    rng = np.random.default_rng(8)
    same = np.sort(rng.choice(600, copies, replace=False))
    x[same] = x[same[0]]
    rows = [(int(i), x[i].tolist()) for i in rng.permutation(600)]
    got = multiprobe_neighbours(vectors(rows).repartition(5), F.col("vec_id") % 20 == 0, k=20, group=150).toPandas()
    again = multiprobe_neighbours(vectors(rows[::-1]).repartition(3), F.col("vec_id") % 20 == 0, k=20, group=150).toPandas()
    order = ["query_id", "rank"]
    assert got.sort_values(order, ignore_index=True).equals(again.sort_values(order, ignore_index=True))
    z = x.astype(float)
    for i, mine in got.groupby("query_id"):
        mine = mine.sort_values("rank")
        s = np.zeros(600)
        for j in range(dim):
            s += z[:, j] * z[i, j]
        assert (mine.score.to_numpy() == s[mine.vec_id]).all()
        assert mine.vec_id.tolist() == sorted(mine.vec_id, key=lambda j: (-s[j], j))
        if i in same:  # its copies come first, those with the smallest ids
            want = [int(j) for j in same if j != i][:20]
            assert mine.vec_id.tolist()[: len(want)] == want


def test_repeated_ids_and_zero_vectors(vectors):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (20, [0.0, 0.0]), (20, [1.0, 1.0])]
    got = multiprobe_neighbours(vectors(rows), F.col("vec_id") % 20 == 0)
    assert {(r.query_id, r.vec_id): r.score for r in got.collect()} == {(0, 1): 2.0, (0, 2): 0.0, (0, 20): 1.0, (20, 0): 1.0, (20, 1): 2.0, (20, 2): 1.0}


def test_top_k_leaves_out_scores_beyond_64_bits(vectors):
    rows = [(0, [1.0, 2.0]), (1, [3e9, 0.0]), (2, [1e300, 1.0]), (3, [5.0, 0.0]), (4, [8e6, 8e6])]
    got = histogram_top_k(vectors(rows), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 1, 3, 256 * 5 * 256)]
    wide = [(i, [float(i)] * 3000) for i in range(4)]
    assert [r.vec_id for r in sorted(histogram_top_k(vectors(wide), F.col("vec_id") == 1).collect(), key=lambda r: r["rank"])] == [3, 2, 0]
