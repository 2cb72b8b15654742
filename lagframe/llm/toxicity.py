"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the presence of its words, of its adjacent word pairs and of its word
pairs at a distance of two, hashed into ``2 ** bits`` places. FTRL-proximal keeps a step size
for each coordinate and an L1 threshold that leaves most weights at exactly zero; the others,
sorted by place, go to the scoring tasks with their code. Fitting takes a bounded sample of
labelled rows, whose hashed features meet in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, labelled_texts
from .shared import text_slices
from .words import MEMO_LIMIT, mix

BITS = 22
SAMPLE = 16_000  # labelled rows to fit on, at most
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.05
EDGES = bytes(c for c in range(128) if not chr(c).isalnum())  # stripped from both ends of words


class PlainWords(dict):
    """Word -> hash of the word without ASCII punctuation around it, within a memo bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word.strip(EDGES))
        if len(word) <= 64:
            self[word] = value
        return value


def features(texts: list[bytes], words: PlainWords, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts in a row (with repeats), and the text each belongs to."""
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.fromiter((h for ws in split for h in map(words.__getitem__, ws)), dtype=np.uint64, count=int(counts.sum()))
    owner = np.repeat(np.arange(len(texts)), counts)
    parts, owners = [mix(flat)], [owner]
    for gap in (1, 2):
        same = owner[gap:] == owner[:-gap] if len(flat) > gap else np.zeros(0, dtype=bool)
        if same.any():
            pair = mix(flat[:-gap] * np.uint64(0x9E3779B97F4A7C15) + flat[gap:] + np.uint64(gap))
            parts.append(pair[same])
            owners.append(owner[gap:][same])
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owners)


def _presence(bits: int):
    """Arrow batches (text, label) -> (label, places), the distinct features of each text."""

    def presence(batches):
        words = PlainWords()
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(0), 1 << 20):
                place, owner = features(texts, words, bits)
                rows = np.unique(owner << bits | place)
                cuts = np.searchsorted(rows >> bits, np.arange(1, hi - lo))
                lists = [x.astype(np.int32) for x in np.split(rows & ((1 << bits) - 1), cuts)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(lists, pa.list_(pa.int32()))], ["label", "places"])

    return presence


def ftrl(rows: list[tuple[int, np.ndarray]], size: int, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes over (label, places) rows in the given order."""
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weights(at):
        zs = z[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zs) <= l1] = 0.0
        return w

    for _ in range(epochs):
        for label, at in rows:
            w = weights(at)
            b = -bias_z / ((beta + np.sqrt(bias_n)) / alpha)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * b
            bias_n += g * g
    return weights(np.arange(size)), float(-bias_z / ((beta + np.sqrt(bias_n)) / alpha))


def _fit(bits: int):
    def fit(table: pa.Table) -> pa.Table:
        rows = list(zip(table["label"].to_pylist(), (x.values.to_numpy() for x in table["places"]), strict=True))
        rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(r[1].tobytes()), r[0]))  # the same order in every run
        weights, bias = ftrl(rows, 1 << bits)
        at = np.flatnonzero(weights)
        return pa.table({"bias": [bias], "places": pa.array([at.astype(np.int32)], pa.list_(pa.int32())), "weights": pa.array([weights[at]], pa.list_(pa.float64()))})

    return fit


def _score(bits: int, bias: float, places: np.ndarray, weights: np.ndarray):
    def score(batches):
        words = PlainWords()
        table = np.zeros(1 << bits, dtype=np.float32)
        table[places] = weights
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for lo, hi, texts in text_slices(batch.column(1), 1 << 20):
                place, owner = features(texts, words, bits)
                used = np.flatnonzero(table[place])
                rows = np.unique(owner[used] << bits | place[used])
                total[lo:hi] += np.bincount(rows >> bits, weights=table[rows & ((1 << bits) - 1)], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))], ["id", "score"])

    return score


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    parts: int = 5,
    part: int = 0,
    sample: int = SAMPLE,
    bits: int = BITS,
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``score``, ``predicted``.

    Labels of held-out ids (crc32 of the id as text modulo ``parts`` equal to ``part``) are
    never seen. Whole texts count. A null or wordless text has no features and scores by the
    bias alone. Without labels every score is 0.5. Null ids are not held out; repeated rows
    score alike. Extra columns are ignored; an empty table gives an empty result.
    """
    known = labelled_texts(docs, labels, id_col, text_col, label_col, parts, part, sample).mapInArrow(_presence(bits), "label int, places array<int>")
    model = known.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit(bits), "bias double, places array<int>, weights array<double>").first()
    bias, places, weights = (0.0, [], []) if model is None else model
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = given.mapInArrow(_score(bits, bias, np.array(places, dtype=np.int64), np.array(weights, dtype=np.float32)), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id", parts, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
