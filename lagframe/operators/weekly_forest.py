"""Walk-forward forests refit every week, and their importances, one series at a time.

Every test week gets a regression forest of its own, grown on all earlier weeks of its
series: the original's rule. The fits are independent and small (a series is bounded by the
calendar), so Spark deals them: each series goes to ``chunks`` groups, and a group fits the
test weeks (or grows the trees) that fall to it. The weeks are sorted once per feature; the
order of an earlier stretch is that order without the later weeks. A fit grows all its trees at
once, level by level, in numpy; a forecast only needs the node that holds the test week, so
the other side of every split is left out.

Tree rules: a node splits where the squared error drops most, over all features and all cuts
halfway between neighbouring values, if ``min_leaf`` distinct weeks stay on either side and the
drop is more than rounding; equal drops go to the earlier feature, then to the lower cut. With
``bootstrap=False`` there is one tree, which takes every week once. The target counts in whole
units of its decimal place ``digits`` (None: as it is), so that sums are exact and equal drops
are equal however the trees are dealt, and in any engine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp_nonneg
from .forecast import BASELINE_WINDOW, FOREST, MIN_TRAIN, baseline_forecast, walk_forward_folds
from .rollup import WEEK, YEAR, _keys

GROWTH = {**FOREST, "bootstrap": True, "digits": 6}
EPSILON = 1e-9  # relative drop of the squared error that a split must exceed


def forest_grower():
    """(predict, gains): the forecast of a forest for one row, and the drop of squared error per
    tree and feature."""

    def start(x, y, orders, draw):
        """Entries (week, tree, weight) of the weeks that each tree (row of ``draw``) took, and
        for each feature the entries in order of tree and value with the values."""
        n = len(y)
        weight = np.bincount((draw + n * np.arange(len(draw))[:, None]).ravel(), minlength=len(draw) * n).reshape(-1, n)
        flat = np.flatnonzero(weight)
        row, tree = flat % n, flat // n
        w = weight.ravel()[flat].astype(float)
        number = np.zeros(weight.size, dtype=np.int64)
        number[flat] = np.arange(len(flat))
        number = number.reshape(weight.shape)
        lines = []
        for f, o in enumerate(orders):
            e = number[:, o][weight[:, o] > 0]
            lines.append((e, x[row[e], f]))
        return row, tree, w, w * y[row], lines

    def splits(lines, cell, cells, w, wy, min_leaf):
        """Per cell: weight, sum, the chosen feature (-1: none), its cut, and the drop."""
        sum_w, sum_y = np.bincount(cell, w, cells), np.bincount(cell, wy, cells)
        count = np.bincount(cell, minlength=cells)
        first = np.cumsum(count) - count
        base_w, base_y = np.cumsum(sum_w) - sum_w, np.cumsum(sum_y) - sum_y
        whole = sum_y**2 / sum_w
        best = whole + EPSILON * (1.0 + np.abs(whole))
        feature, cut = np.full(cells, -1), np.zeros(cells)
        for f, (e, value) in enumerate(lines):
            own = cell[e]
            left = np.arange(1, len(e) + 1) - first[own]
            open_ = (left >= min_leaf) & (count[own] - left >= min_leaf)
            open_[:-1] &= value[1:] > value[:-1]
            at = np.flatnonzero(open_)
            if not len(at):
                continue
            own = own[at]
            lw, ly = np.cumsum(w[e])[at] - base_w[own], np.cumsum(wy[e])[at] - base_y[own]
            rw, ry = sum_w[own] - lw, sum_y[own] - ly
            score = ly**2 / lw + ry**2 / rw
            begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            top, of = np.maximum.reduceat(score, begins), own[begins]
            better = top > best[of]
            if better.any():
                highest = np.full(cells, np.inf)
                highest[of[better]] = top[better]
                hit = np.flatnonzero(score == highest[own])
                found, where = np.unique(own[hit], return_index=True)
                place = at[hit[where]]
                best[found], feature[found], cut[found] = score[hit[where]], f, (value[place] + value[place + 1]) / 2.0
        return sum_w, sum_y, feature, cut, best - whole

    def predict(x, y, orders, test, draw, max_depth, min_leaf):
        """The forest's mean for the row ``test``."""
        row, cell, w, wy, lines = start(x, y, orders, draw)
        mean, following = np.zeros(len(draw)), np.arange(len(draw))
        for level in range(max_depth + 1):
            cells = len(following)
            if level == max_depth:
                mean[following] = np.bincount(cell, wy, cells) / np.bincount(cell, w, cells)
                break
            sum_w, sum_y, feature, cut, _ = splits(lines, cell, cells, w, wy, min_leaf)
            mean[following] = sum_y / sum_w
            split = feature >= 0
            if not split.any():
                break
            chosen = np.maximum(feature, 0)
            keep = split[cell] & ((x[row, chosen[cell]] > cut[cell]) == (test[chosen] > cut)[cell])
            number = np.cumsum(keep) - 1
            lines = [(number[e[k]], value[k]) for e, value in lines for k in (keep[e],)]
            following = following[split]
            row, w, wy, cell = row[keep], w[keep], wy[keep], (np.cumsum(split) - 1)[cell[keep]]
        return float(mean.mean())

    def gains(x, y, orders, draw, max_depth, min_leaf):
        """Drop of squared error by tree (rows) and feature (columns) over the whole trees."""
        row, cell, w, wy, lines = start(x, y, orders, draw)
        drops, tree = np.zeros((len(draw), x.shape[1])), np.arange(len(draw))
        for _ in range(max_depth):
            _, _, feature, cut, drop = splits(lines, cell, len(tree), w, wy, min_leaf)
            split = feature >= 0
            if not split.any():
                break
            np.add.at(drops, (tree[split], feature[split]), drop[split])
            keep = split[cell]
            child = (2 * (np.cumsum(split) - 1))[cell] + (x[row, np.maximum(feature, 0)[cell]] > cut[cell])
            number = np.cumsum(keep) - 1
            row, w, wy, cell = row[keep], w[keep], wy[keep], child[keep]
            tree = np.repeat(tree[split], 2)
            kind = np.uint16 if len(tree) < 1 << 16 else np.int64  # 16 bits sort by radix
            lines = [(number[e[k]], value[k]) for e, value in lines for k in (keep[e],)]
            order = [np.argsort(cell[e].astype(kind), kind="stable") for e, _ in lines]
            lines = [(e[o], value[o]) for (e, value), o in zip(lines, order, strict=True)]
        return drops

    return predict, gains


def _dealt(frame: DataFrame, keys: list[str], chunks: int, partitions: int) -> DataFrame:
    """Every series in ``chunks`` copies, each a group of its own. Few rows, much work: a fixed
    number of partitions keeps the adaptive planner from merging them."""
    spread = frame.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    parts = max(partitions, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.repartition(parts, *keys, "_chunk")


def walk_forward_weekly(
    frame: DataFrame,
    target: str,
    climate_features: Sequence[str],
    full_features: Sequence[str],
    keys=None,
    min_train: int = MIN_TRAIN,
    baseline_window: int = BASELINE_WINDOW,
    forest: Mapping | None = None,
    chunks: int = 16,
    partitions: int = 64,
) -> DataFrame:
    """One-step-ahead walk-forward per series: baseline, forest on climate, forest on climate
    and past values, both refit before every test week.

    The groups go to at least ``partitions`` tasks. Rows with a missing target or feature are
    left out. Series of ``min_train`` rows or fewer
    have no test rows. Output: keys, year, week, real, pred_baseline, pred_rf_climate,
    pred_rf_full.
    """
    keys = _keys(keys)
    params = {**GROWTH, **(forest or {})}
    unit = 10.0 ** params["digits"] if params["digits"] is not None else None
    climate, full = list(climate_features), list(full_features)
    used = list(dict.fromkeys([*climate, *full]))
    f = frame.dropna(subset=[target, *used])
    f = walk_forward_folds(baseline_forecast(f, target, baseline_window, keys), keys, min_train)
    f = f.select(*keys, YEAR, WEEK, F.col(target).cast("double").alias("real"), "pred_baseline", *[F.col(c).cast("double").alias(c) for c in used], "row_no", "is_test")
    spread = _dealt(f, keys, chunks, partitions)
    names = [*keys, YEAR, WEEK, "real", "pred_baseline"]
    predict, _ = forest_grower()

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("row_no")
        chunk = table["_chunk"][0].as_py()
        y, row = table["real"].to_numpy(), table["row_no"].to_numpy()
        y = np.round(y * unit) if unit else y
        mine = np.flatnonzero(table["is_test"].to_numpy(zero_copy_only=False) & (row % chunks == chunk))
        out = table.select(names).take(pa.array(mine))
        for column, features in (("pred_rf_climate", climate), ("pred_rf_full", full)):
            x = np.column_stack([table[c].to_numpy() for c in features])
            orders = [np.argsort(x[:, c], kind="stable") for c in range(x.shape[1])]
            found = []
            for i in mine:
                drawn = np.random.default_rng([params["seed"], int(row[i])]).integers(0, i, (params["num_trees"], i)) if params["bootstrap"] else np.arange(i)[None, :]
                mean = predict(x[:i], y[:i], [o[o < i] for o in orders], x[i], drawn, params["max_depth"], params["min_leaf"])
                found.append(mean / unit if unit else mean)
            out = out.append_column(column, pa.array(found, pa.float64()))
        return out

    kinds = ", ".join(f"`{c}` {spread.schema[c].dataType.simpleString()}" for c in names) + ", pred_rf_climate double, pred_rf_full double"
    done = spread.groupBy(*keys, "_chunk").applyInArrow(fit, kinds)
    return done.withColumns({c: clamp_nonneg(c) for c in ("pred_rf_climate", "pred_rf_full")})


def forest_importance(
    frame: DataFrame,
    target: str,
    features: Sequence[str],
    keys=None,
    forest: Mapping | None = None,
    chunks: int = 8,
    partitions: int = 64,
) -> DataFrame:
    """Importances of a forest on all rows of each series, largest first (I3, G4): a feature's
    share of a tree's drop in squared error, averaged over the trees that split at all.

    The trees of a series are dealt to ``chunks`` groups and their shares added up by Spark, so
    any number of series and trees spreads. Rows with a missing target or feature are left
    out; a series whose trees never split has null importances. Output: keys, feature,
    importance.
    """
    keys, features = _keys(keys), list(features)
    params = {**GROWTH, **(forest or {})}
    unit = 10.0 ** params["digits"] if params["digits"] is not None else None
    f = frame.dropna(subset=[target, *features])
    f = f.select(*keys, YEAR, WEEK, F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in features])
    _, gains = forest_grower()

    def grow(table: pa.Table) -> pa.Table:
        chunk = table["_chunk"][0].as_py()
        table = table.sort_by([(YEAR, "ascending"), (WEEK, "ascending")])
        y = table["_y"].to_numpy()
        x = np.column_stack([table[c].to_numpy() for c in features])
        trees = range(chunk, params["num_trees"] if params["bootstrap"] else 1, chunks)
        out = table.slice(0, 1).select(keys)
        shares, grown = np.zeros(len(features)), 0.0
        if trees:
            orders = [np.argsort(x[:, c], kind="stable") for c in range(x.shape[1])]
            drawn = np.stack([np.random.default_rng([params["seed"], t]).integers(0, len(y), len(y)) if params["bootstrap"] else np.arange(len(y)) for t in trees])
            drops = gains(x, np.round(y * unit) if unit else y, orders, drawn, params["max_depth"], params["min_leaf"])
            split = drops.sum(axis=1) > 0
            shares, grown = (drops[split] / drops[split].sum(axis=1, keepdims=True)).sum(axis=0), float(split.sum())
        out = out.take(pa.array(np.zeros(len(features), dtype=np.int64)))
        out = pa.table({**{k: out[k] for k in keys}, "feature": pa.array(features), "share": pa.array(shares), "trees": pa.array(np.full(len(features), grown))})
        return out

    spread = _dealt(f, keys, chunks, partitions)
    kinds = "".join(f"`{c}` {spread.schema[c].dataType.simpleString()}, " for c in keys) + "feature string, share double, trees double"
    parts = spread.groupBy(*keys, "_chunk").applyInArrow(grow, kinds)
    found = parts.groupBy(*keys, "feature").agg(F.try_divide(F.sum("share"), F.sum("trees")).alias("importance"))
    return found.orderBy(*keys, F.col("importance").desc_nulls_last(), "feature")
