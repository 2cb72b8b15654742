"""Quality by a generalised additive model with pairwise interactions.

Each feature's values are cut at quantiles into bins. Cyclic boosting visits the features in
turn, fits a shallow tree (two cuts, three leaves) of the logistic gradients to the bins of
that one feature, and adds a small step of it to the feature's lookup table. Pairs of
features whose quadrants reduce the remaining error most get tables of their own, boosted the
same way with one cut on either feature. A score is the sum of table entries, found by bin,
through the logistic function. Fitting takes a bounded sample of labelled rows, whose
features alone go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, labelled_texts
from .shared import text_slices, utf8
from .words import WordHashes, sequence_hash

SAMPLE = 20_000  # labelled rows to fit on, at most
BINS = 32
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE = 0.15
LEAST = 20  # rows in a leaf
FEATURES = (
    "words", "word_length", "upper", "digit", "symbol", "stop", "bang", "bar", "line_words",
    "distinct_words", "distinct_pairs", "top_word", "repeated_fives", "repeated_lines", "marked_words", "wide",
)

_KINDS = np.zeros((256, 8), dtype=bool)  # of bytes: upper, lower, digit, symbol, stop, "!", "|", part of a wider character
for _c in range(128):
    _KINDS[_c] = [chr(_c).isupper(), chr(_c).islower(), chr(_c).isdigit(), chr(_c) in "#$%&*+<=>@\\^_`{}~", chr(_c) in ".?", chr(_c) == "!", chr(_c) == "|", False]
_KINDS[128:, 7] = True
_KINDS = _KINDS.T.copy()


def text_features(texts: list[bytes], hashes: WordHashes) -> np.ndarray:
    """One row of ``FEATURES`` per text; all zero for an empty text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        if not text:
            continue
        counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        upper, lower, digit, symbol, stop, bang, bar, wide = (int(counts[k].sum()) for k in _KINDS)
        raw = text.split()
        n, size = max(1, len(raw)), len(text)
        lines = [x for x in text.split(b"\n") if x.strip()]
        h = hashes.of(raw)
        _, times = np.unique(h, return_counts=True)
        pairs = sequence_hash([h[:-1], h[1:]]) if len(h) > 1 else h[:0]
        fives = np.unique(sequence_hash([h[k : len(h) - 4 + k] for k in range(5)])) if len(h) > 4 else None
        marked = symbol / n
        out[i] = (
            np.log1p(len(raw)),
            sum(map(len, raw)) / n,
            upper / max(1, upper + lower),
            digit / size,
            symbol / size,
            stop / n,
            bang / n,
            bar / n,
            len(raw) / max(1, len(lines)),
            len(times) / n,
            len(np.unique(pairs)) / max(1, len(pairs)),
            (times.max() if len(times) else 0) / n,
            1 - len(fives) / (len(h) - 4) if fives is not None else 0.0,
            1 - len(set(lines)) / max(1, len(lines)),
            marked,
            wide / size,
        )
    return out


class AdditiveModel:
    """Bin edges, one table per feature and one per chosen pair of features."""

    def __init__(self, bins: int = BINS):
        self.bins, self.bias, self.edges, self.tables, self.pairs = bins, 0.0, [], [], {}

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        at = self.binned(x)
        total = np.full(len(x), self.bias)
        for j, table in enumerate(self.tables):
            total += table[at[:, j]]
        for (a, b), table in self.pairs.items():
            total += table[at[:, a], at[:, b]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -35, 35)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        if not len(y):
            return self
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        self.bias = float(np.log(rate / (1 - rate)))
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
        self.tables = [np.zeros(self.bins + 1) for _ in self.edges]
        at, total = self.binned(x), np.full(len(y), self.bias)
        width = self.bins + 1

        def slopes():
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            return y - p, np.maximum(p * (1 - p), 1e-6)

        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                g, h = slopes()
                step = RATE * _tree(*(np.bincount(at[:, j], w, width) for w in (g, h)), np.bincount(at[:, j], minlength=width))
                table += step
                total += step[at[:, j]]
        cells = {(a, b): at[:, a] * width + at[:, b] for a in range(len(self.edges)) for b in range(a + 1, len(self.edges))}
        g, h = slopes()
        gains = {ab: _quadrants(*(np.bincount(c, w, width * width).reshape(width, width) for w in (g, h)))[0] for ab, c in cells.items()}
        chosen = sorted(gains, key=lambda ab: (-gains[ab], ab))[:PAIRS]
        self.pairs = {ab: np.zeros((width, width)) for ab in chosen}
        for _ in range(PAIR_ROUNDS):
            for ab, table in self.pairs.items():
                g, h = slopes()
                step = RATE * _quadrants(*(np.bincount(cells[ab], w, width * width).reshape(width, width) for w in (g, h)))[1]
                table += step
                total += step[at[:, ab[0]], at[:, ab[1]]]
        return self


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Newton steps by bin of a tree with two cuts: the best cut, then the best within a half."""
    step = np.zeros(len(g))

    def best(lo: int, hi: int):
        gs, hs, ns = (np.cumsum(v[lo:hi]) for v in (g, h, n))
        gain = gs[:-1] ** 2 / (hs[:-1] + 1.0) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1.0) - gs[-1] ** 2 / (hs[-1] + 1.0)
        gain[(ns[:-1] < LEAST) | (ns[-1] - ns[:-1] < LEAST)] = 0.0
        k = int(np.argmax(gain)) if len(gain) else 0
        return (float(gain[k]), lo + k + 1) if len(gain) else (0.0, hi)

    leaves = [(0, len(g))]
    for _ in range(2):
        (gain, cut), leaf = max(((best(*leaf), leaf) for leaf in leaves), key=lambda f: f[0][0])
        if gain <= 0:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], cut), (cut, leaf[1])]
    for lo, hi in leaves:
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1.0)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts, one on either axis: what it gains, and Newton steps by cell."""
    gs, hs = (v.cumsum(0).cumsum(1) for v in (g, h))
    total_g, total_h = gs[-1, -1], hs[-1, -1]

    def parts(s, total):
        low = s[:-1, :-1]
        left, top = s[:-1, -1:] - low, s[-1:, :-1] - low
        return low, left, top, total - low - left - top

    gp, hp = parts(gs, total_g), parts(hs, total_h)
    gain = sum(a * a / (b + 1.0) for a, b in zip(gp, hp, strict=True)) - total_g**2 / (total_h + 1.0)
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    low, left, top, rest = (a[r, c] / (b[r, c] + 1.0) for a, b in zip(gp, hp, strict=True))
    step = np.empty_like(g)
    step[: r + 1, : c + 1], step[: r + 1, c + 1 :], step[r + 1 :, : c + 1], step[r + 1 :, c + 1 :] = low, left, top, rest
    return float(gain[r, c]), step


def _measure(batches):
    """Arrow batches (text, label) -> (label, x)."""
    hashes = WordHashes()
    for batch in batches:
        x = text_features(utf8(batch.column(0)), hashes)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def _scores_of(model: AdditiveModel, column: pa.Array, hashes: WordHashes) -> np.ndarray:
    if not model.edges:
        return np.full(len(column), 0.5)
    return np.concatenate([np.empty(0), *(model.scores(text_features(texts, hashes)) for _, _, texts in text_slices(column, 1 << 22))])


def _score(model: AdditiveModel):
    def score(batches):
        hashes = WordHashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores_of(model, batch.column(1), hashes))], ["id", "score"])

    return score


def _keep(model: AdditiveModel, column: str, least: float):
    def keep(batches):
        hashes = WordHashes()
        for batch in batches:
            yield batch.filter(pa.array(_scores_of(model, batch.column(column), hashes) >= least))

    return keep


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, parts: int, part: int, sample: int) -> AdditiveModel:
    """The model of a bounded sample; the sample's features are sorted, so that every run
    fits the same one."""
    known = labelled_texts(docs, labels, id_col, text_col, label_col, parts, part, sample).mapInArrow(_measure, "label int, x array<double>").toArrow()
    rows = sorted(zip(known["x"].to_pylist(), known["label"].to_pylist(), strict=True))
    return AdditiveModel().fit(np.array([x for x, _ in rows]).reshape(len(rows), len(FEATURES)), np.array([y for _, y in rows], dtype=float))


def quality_filter(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", parts: int = 3, part: int = 1, sample: int = SAMPLE, least: float = 0.5
) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``least`` or more; see ``quality_scores``."""
    model = fitted(docs, labels, id_col, text_col, label_col, parts, part, sample)
    return docs.mapInArrow(_keep(model, text_col, least), docs.schema)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    parts: int = 3,
    part: int = 1,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``score``, ``predicted``.

    Labels of held-out ids (crc32 of the id as text modulo ``parts`` equal to ``part``) are
    never seen. Features are of whole texts. A null or empty text has all features 0 and is
    scored by them. Without labels every score is 0.5. Null ids are not held out; repeated
    rows score alike. Extra columns are ignored; an empty table gives an empty result.
    """
    model = fitted(docs, labels, id_col, text_col, label_col, parts, part, sample)
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = given.mapInArrow(_score(model), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id", parts, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
