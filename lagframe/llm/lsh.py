"""Approximate nearest neighbours by multiprobe p-stable hashing.

For the largest inner product vectors are lifted onto the unit sphere (a norm component makes
every lifted vector as long as the longest one), where the nearest vector has the largest
product. Each table cuts ``functions`` Gaussian projections into slots of ``width``; a bucket
is one slot of each. A neighbour of norm r times the longest has a norm component s, with
r * r + s * s = 1. If its lifted cosine to a query is c, the query's projection f and the
component's own weight a, it projects normally around c * f + s * a with variance r * r - c * c,
so each bucket near the query's own, all of them perturbations of it, has an estimated
success: the product of its slots' normal probabilities. A query visits buckets in the order
of this estimate, summed over the bands of norms that occur, until each band's success
reaches ``success``. The expected cosine is what the k-th neighbour reaches for nine queries
in ten among the lifted vectors, fitted on a bounded sample.

Every row is indexed in every table. A table's buckets are dealt into groups of about
``group`` rows, larger buckets split among several; a query goes once to each group that holds
buckets it visits, and a task returns its ``k`` nearest there by the exact inner product. The
tables' candidates merge by query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut
from .topk import matrix, usable_vectors

TABLES = 2
FUNCTIONS = 4
WIDTH = 1.5
SUCCESS = 0.78  # of one table; both together find 95 of 100 expected neighbours
GROUP = 8192
SAMPLE = 4096  # vectors on which the expected cosine is fitted
BAND = 0.75  # norms of one band lie within this ratio
BANDS = 24  # all shorter norms, a thousandth of the longest, share the last band
EDGE = 4  # slots beyond this projection join the outermost one


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2.0)))


class Tables:
    """Projections and slot edges of all tables, drawn from ``seed``."""

    def __init__(self, dim: int, cosine: float, norms: list[float], tables: int, functions: int, width: float, seed: int):
        """``norms``: of each band, as shares of the longest norm."""
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((tables, dim + 1, functions))
        inner = int(2 * EDGE / width)
        self.edges = np.sort(rng.uniform(0, width, (tables, functions)))[:, :, None] - EDGE + width * np.arange(inner)[None, None, :]
        self.slots, self.cosine = inner + 1, min(max(cosine, 0.0), 0.95)
        # a vector shorter than the expected cosine can't reach it
        long = [r for r in norms if r * 0.95 >= self.cosine] or [max(norms)]
        self.cosine = min(self.cosine, 0.95 * min(long))
        self.norms = np.minimum(np.array(long), 1.0)
        self.functions, self.count = functions, tables

    def buckets(self, lifted: np.ndarray, table: int) -> np.ndarray:
        f = lifted @ self.planes[table]
        out = np.zeros(len(f), dtype=np.int64)
        for i in range(self.functions):
            out = out * self.slots + np.searchsorted(self.edges[table, i], f[:, i], side="right")
        return out

    def visits(self, lifted: np.ndarray, table: int, success: float) -> list[np.ndarray]:
        """Buckets each query visits, in order of estimated success in all bands of norms."""
        f = lifted @ self.planes[table]
        bands = []
        for norm in self.norms:
            spread, lift = math.sqrt(norm**2 - self.cosine**2), math.sqrt(1 - norm**2)
            estimate = np.ones((len(f), 1))
            for i in range(self.functions):
                centre = self.cosine * f[:, i, None] + lift * self.planes[table, -1, i]
                below = _normal_cdf((self.edges[table, i][None, :] - centre) / spread)
                slot = np.diff(np.hstack([np.zeros((len(f), 1)), below, np.ones((len(f), 1))]), axis=1)
                estimate = (estimate[:, :, None] * slot[:, None, :]).reshape(len(f), -1)
            bands.append(estimate)
        order = np.argsort(-sum(bands), axis=1, kind="stable")
        reached = np.min([np.cumsum(np.take_along_axis(b, order, 1), axis=1) for b in bands], axis=0)
        return [o[: 1 + int(np.searchsorted(r, success))] for o, r in zip(order, reached, strict=True)]


def _lift(vectors: np.ndarray, dim: int, longest: float, query: bool) -> np.ndarray:
    """Unit vectors of one more dimension; short vectors end in zeros."""
    out = np.zeros((len(vectors), dim + 1))
    out[:, : vectors.shape[1]] = vectors
    norm = np.sqrt((out * out).sum(axis=1))
    if query:
        return out / norm[:, None]
    out /= longest
    out[:, dim] = np.sqrt(np.maximum(0.0, 1.0 - (norm / longest) ** 2))
    return out


def _index(tables: Tables, dim: int, longest: float):
    def index(batches):
        for batch in batches:
            lifted = _lift(matrix(batch.column(1)), dim, longest, False)
            for t in range(tables.count):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(tables.buckets(lifted, t))], ["vec_id", "vec", "tab", "bucket"]
                )

    return index


def _probe(tables: Tables, dim: int, success: float):
    def probe(batches):
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                lifted = _lift(matrix(part.column(1)), dim, 1.0, True)
                for t in range(tables.count):
                    visits = tables.visits(lifted, t, success)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(np.full(part.num_rows, t, np.int32)), pa.array(visits, pa.list_(pa.int64()))], ["vec_id", "vec", "tab", "visits"]
                    )

    return probe


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that a row's score does not depend on
    its place among others and equal vectors tie."""
    out = np.zeros(len(rows))
    for column, x in zip(rows.T, query, strict=True):
        out += column * x
    return out


def _best(k: int):
    """Exact scores of a group's rows in the buckets its queries visit (null: all); ``k`` a
    query."""

    def best(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ask = np.asarray(table["ask"].combine_chunks())
        q, c = table.filter(pa.array(ask)), table.filter(pa.array(~ask))
        found_q, found_c, found_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if q.num_rows and c.num_rows:
            qm, cm = matrix(q["vec"].combine_chunks()), matrix(c["vec"].combine_chunks())
            width = max(qm.shape[1], cm.shape[1])
            qm, cm = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (qm, cm))
            ids, owner = c["vec_id"].to_numpy(), c["bucket"].to_numpy()
            names, place = np.unique(owner, return_inverse=True)
            asks = q["visits"].combine_chunks()
            longest = np.sqrt((cm * cm).sum(axis=1).max())
            for i, own in enumerate(q["vec_id"].to_numpy()):
                seen = ids != own
                if asks[i].is_valid:
                    seen &= np.isin(names, asks[i].values.to_numpy())[place]
                rows = np.flatnonzero(seen)
                if len(rows) > 4 * k:  # all that may be among the k best, however the product rounds
                    rough = cm[rows] @ qm[i]
                    slack = 4 * width * np.finfo(float).eps * longest * np.sqrt(qm[i] @ qm[i])
                    rows = rows[rough >= np.partition(rough, len(rows) - k)[len(rows) - k] - slack]
                scores = _exact(cm[rows], qm[i])
                top = np.lexsort((ids[rows], -scores))[:k]
                found_q.append(np.full(len(top), own, np.int64))
                found_c.append(ids[rows][top])
                found_s.append(scores[top])
        return pa.table({"query_id": np.concatenate(found_q), "vec_id": np.concatenate(found_c), "score": np.concatenate(found_s)})

    return best


def _expected_cosine(sample: np.ndarray, total: int, k: int, longest: float) -> float:
    """Cosine that the k-th of ``total`` neighbours reaches for nine queries in ten, from a
    sample lifted like the vectors: each sampled query's own quantile of cosines, by a normal
    tail where the sample is too small for it. A large group of like vectors raises it for its
    members only, a few long vectors don't widen the tail."""
    if len(sample) < 3:
        return 0.0
    asked = sample[:256]
    cos = (asked / np.sqrt((asked * asked).sum(axis=1))[:, None]) @ (sample / longest).T
    np.fill_diagonal(cos, np.nan)
    share = min(0.5, k / max(total, 1))
    if share * len(sample) >= 2:
        reached = np.nanquantile(cos, 1 - share, axis=1)
    else:
        tail = math.log(1 / share)
        z = math.sqrt(max(0.0, 2 * tail - math.log(4 * math.pi * tail)))
        low, middle, high = np.nanquantile(cos, [0.1587, 0.5, 0.8413], axis=1)
        reached = np.minimum(np.nanmean(cos, axis=1) + z * np.nanstd(cos, axis=1), middle + z * (high - low) / 2)
    return float(np.quantile(reached, 0.1))


def multiprobe_neighbours(
    rows: DataFrame,
    is_query,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    width: float = WIDTH,
    success: float = SUCCESS,
    group: int = GROUP,
    sample: int = SAMPLE,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best inner products found.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows but the query's own id.
    Vectors that are null, zero or hold null or non-finite components, and rows without an id,
    take no part; rows repeating an id count as one, the smallest vector that takes part. Vectors of different length compare as
    if padded with zeros. Queries that find fewer than ``k`` rows visit every bucket, so all
    candidates return if there are fewer. Ties go to the smaller id. Extra columns are
    ignored; an empty table gives an empty result.
    """
    squares = "aggregate(vec, 0D, (s, x) -> s + x * x)"
    vectors = cut(usable_vectors(rows, id_col, vector_col, nonzero=True), "lsh-vectors")
    total, longest, dim = vectors.agg(F.count("*"), F.max(F.expr(f"sqrt({squares})")), F.max(F.size("vec"))).first()
    kind = "query_id long, vec_id long, score double"
    spark = rows.sparkSession
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    picked = vectors.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    lengths = vectors.select((F.expr(f"sqrt({squares})") / F.lit(longest)).alias("norm"))
    bands = F.least(F.floor(F.log("norm") / math.log(BAND) + 1e-6), F.lit(BANDS))
    norms = [r.norm for r in lengths.groupBy(bands.alias("band")).agg(F.avg("norm").alias("norm")).collect()]
    model = Tables(dim, _expected_cosine(matrix(picked), total, k, longest), norms, tables, functions, width, seed)

    indexed = cut(vectors.mapInArrow(_index(model, dim, longest), "vec_id long, vec array<double>, tab int, bucket long"), "lsh-index")
    # buckets in order fill groups of about `group` rows; a larger bucket splits among several
    sizes = indexed.groupBy("tab", "bucket").agg(F.count("*").alias("held"))
    fill = Window.partitionBy("tab").orderBy("bucket")
    sizes = sizes.withColumn("upto", F.sum("held").over(fill)).withColumn("first", F.floor((F.col("upto") - F.col("held")) / group)).withColumn("parts", F.ceil(F.col("held") / F.lit(group)))
    sizes = cut(sizes.select("tab", "bucket", "first", "parts"), "lsh-buckets")
    filed = indexed.join(sizes, ["tab", "bucket"]).withColumn("grp", F.expr("first + pmod(xxhash64(vec_id), parts)"))
    filed = filed.select("tab", "grp", "vec_id", "vec", "bucket", F.lit(None).cast("array<long>").alias("visits"), F.lit(False).alias("ask"))

    asked = cut(vectors.filter(is_query).mapInArrow(_probe(model, dim, success), "vec_id long, vec array<double>, tab int, visits array<long>"), "lsh-visits")
    goes = (
        asked.select("tab", "vec_id", F.explode("visits").alias("bucket"))
        .join(sizes, ["tab", "bucket"])
        .select("tab", "vec_id", "bucket", F.explode(F.expr("sequence(first, first + parts - 1)")).alias("grp"))
        .groupBy("tab", "vec_id", "grp")
        .agg(F.collect_list("bucket").alias("visits"))
    )
    asking = goes.join(asked.select("tab", "vec_id", "vec"), ["tab", "vec_id"]).select("tab", "grp", "vec_id", "vec", F.lit(None).cast("long").alias("bucket"), "visits", F.lit(True).alias("ask"))
    found = filed.unionByName(asking).groupBy("tab", "grp").applyInArrow(_best(k), kind)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = cut(merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "lsh-top")
    short = vectors.filter(is_query).select("vec_id", "vec").join(top.filter(F.col("rank") == min(k, total - 1)).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    short = cut(short, "lsh-short")
    if total == 1 or short.isEmpty():
        return top
    every = indexed.filter("tab = 0").join(sizes, ["tab", "bucket"]).select(F.expr("first + pmod(xxhash64(vec_id), parts)").alias("grp"), "vec_id", "vec", "bucket", F.lit(None).cast("array<long>").alias("visits"), F.lit(False).alias("ask"))
    last = sizes.filter("tab = 0").agg(F.max(F.expr("first + parts - 1"))).first()[0]
    spread = short.select(F.explode(F.sequence(F.lit(0), F.lit(last))).cast("long").alias("grp"), "vec_id", "vec", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("array<long>").alias("visits"), F.lit(True).alias("ask"))
    rest = every.unionByName(spread).groupBy("grp").applyInArrow(_best(k), kind)
    rest = rest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    return top.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
