"""Exact top-k by distributed histogram selection.

Vectors become integers, floor(scale * x). Queries meet all candidates in blocks: both are
dealt into groups by hash, a query goes to every candidate group and a candidate to every
query group, and a task scores one pair of groups by one matrix product. A pass returns, per
query and block, counts of scores by histogram bin; only bins at or above the block's own
k-th score are needed, at most k of them. Summed over the blocks they show the bin of the
global k-th score, which the next pass cuts finer, until the k-th score itself is known. A
last pass returns the scores at or above it, at most k per query and block, and ties go to
the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

BINS = 1024
QUERY_GROUP = 1024
CANDIDATE_GROUP = 8192


LONGEST = float(1 << 31)  # vectors of this norm or more, scaled, could have scores beyond 64 bits


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str, floor_scale: float | None = None, nonzero: bool = False) -> DataFrame:
    """(vec_id, vec) of the rows whose vector is not null and has finite components only, and,
    with ``nonzero``, some component that is not 0; with ``floor_scale`` the components become
    floor(floor_scale * x), and vectors whose norm then reaches ``LONGEST`` are left out. Rows
    without an id take no part; of rows repeating an id, the smallest vector that is left
    counts."""
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    kept = kept.filter("vec_id is not null and vec is not null").filter("forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    if nonzero:
        kept = kept.filter("exists(vec, x -> x <> 0)")
    if floor_scale is not None:
        kept = kept.filter(f"forall(vec, x -> abs({floor_scale}D * x) < {LONGEST}D)")
        kept = kept.withColumn("vec", F.expr(f"transform(vec, x -> cast(floor({floor_scale}D * x) as double))"))
        kept = kept.filter(f"aggregate(vec, 0D, (s, x) -> s + x * x) < {LONGEST * LONGEST}D")
    return kept.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a matrix; shorter vectors end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where they are exact, else in 64-bit integers."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, c))
    if width * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) < 2**53:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def dealt_pairs(queries: DataFrame, candidates: DataFrame, query_groups: int, candidate_groups: int) -> DataFrame:
    """Both tables with a group pair (qg, cg) and the flag ``ask``; each row as often as the
    other side has groups."""
    own_q = F.expr(f"cast(pmod(xxhash64(vec_id, 1), {query_groups}) as int)")
    own_c = F.expr(f"cast(pmod(xxhash64(vec_id, 2), {candidate_groups}) as int)")
    asked = queries.withColumn("qg", own_q).withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(candidate_groups - 1)))).withColumn("ask", F.lit(True))
    found = candidates.withColumn("cg", own_c).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1)))).withColumn("ask", F.lit(False))
    return asked.unionByName(found, allowMissingColumns=True)


def _parts(table: pa.Table):
    ask = np.asarray(table["ask"].combine_chunks())
    table = table.combine_chunks()
    q, c = table.filter(pa.array(ask)), table.filter(pa.array(~ask))
    return q, c, matrix(q["vec"].combine_chunks()), matrix(c["vec"].combine_chunks())


def _scores(q, c, qm, cm):
    """Per query: its row number, and the ids and scores of the other rows of the block."""
    ids = c["vec_id"].to_numpy()
    table = products(qm, cm)
    for i, own in enumerate(q["vec_id"].to_numpy()):
        others = ids != own
        yield i, ids[others], table[i][others]


def _histogram(k: int):
    def count(table: pa.Table) -> pa.Table:
        q, c, qm, cm = _parts(table)
        out_q, out_bin, out_n = [], [], []
        if q.num_rows and c.num_rows:
            lo, step = q["lo"].to_numpy(), q["step"].to_numpy()
            for i, _, scores in _scores(q, c, qm, cm):
                if len(scores) > k:
                    scores = scores[scores >= np.partition(scores, len(scores) - k)[len(scores) - k]]
                bins, n = np.unique((scores - lo[i]) // step[i], return_counts=True)
                out_q += [q["vec_id"][i].as_py()] * len(bins)
                out_bin += bins.tolist()
                out_n += n.tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "bin": pa.array(out_bin, pa.int64()), "n": pa.array(out_n, pa.int64())})

    return count


def _select(k: int):
    def select(table: pa.Table) -> pa.Table:
        q, c, qm, cm = _parts(table)
        out_q, out_c, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if q.num_rows and c.num_rows:
            lo = q["lo"].to_numpy()
            for i, ids, scores in _scores(q, c, qm, cm):
                over = scores >= lo[i]
                ids, scores = ids[over], scores[over]
                best = np.lexsort((ids, -scores))[:k]
                out_q.append(np.full(len(best), q["vec_id"][i].as_py(), np.int64))
                out_c.append(ids[best])
                out_s.append(scores[best])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_c), "score": np.concatenate(out_s)})

    return select


def histogram_top_k(
    rows: DataFrame,
    is_query,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    bins: int = BINS,
    query_group: int = QUERY_GROUP,
    candidate_group: int = CANDIDATE_GROUP,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows but the query's own
    id. Null vectors, vectors with null or non-finite components and rows without an id take
    no part; rows repeating an id count as one. Vectors of different length compare as if
    padded with zeros. Vectors whose scaled norm is ``LONGEST`` or more take no part: their
    scores might not fit into 64 bits. With fewer than ``k`` candidates all return. Extra columns are ignored;
    an empty table gives an empty result.
    """
    vectors = cut(usable_vectors(rows, id_col, vector_col, scale), "topk-vectors")
    norm = "sqrt(aggregate(vec, 0D, (s, x) -> s + x * x))"
    total, asked, longest = vectors.agg(F.count("*"), F.sum(F.when(is_query, 1).otherwise(0)), F.max(F.expr(norm))).first()
    queries = vectors.filter(is_query)
    # a score lies within the product of the norms; lo and step describe the histogram
    bound = F.ceil(F.expr(norm) * F.lit(longest or 0.0)) + 1
    ranges = cut(queries.select(F.col("vec_id").alias("query_id"), (-bound).cast("long").alias("lo"), F.ceil((2 * bound + 1) / bins).cast("long").alias("step")), "topk-ranges")
    query_groups, candidate_groups = 1 + int(asked or 0) // query_group, 1 + int(total) // candidate_group

    def paired(ranges):
        asking = queries.join(ranges.withColumnRenamed("query_id", "vec_id"), "vec_id")
        return dealt_pairs(asking, vectors, query_groups, candidate_groups).groupBy("qg", "cg")

    while ranges.filter("step > 0").limit(1).count():
        counts = paired(ranges).applyInArrow(_histogram(k), "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        upper = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        reached = counts.withColumn("upto", F.sum("n").over(upper)).withColumn("holds", F.col("upto") >= k)
        # the first bin from above with which k scores are reached; all bins, if there are fewer
        kth = reached.groupBy("query_id").agg(F.max(F.when(F.col("holds"), F.col("bin"))).alias("bin"))
        left = ranges.join(kth, "query_id", "left").withColumn("at", F.col("lo") + F.col("bin") * F.col("step"))
        ranges = cut(
            left.select(
                "query_id",
                F.coalesce("at", "lo").alias("lo"),
                F.when(F.col("at").isNull() | (F.col("step") <= 1), 0).otherwise(F.ceil(F.col("step") / bins)).cast("long").alias("step"),
            ),
            "topk-ranges",
        )
    best = paired(ranges).applyInArrow(_select(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
