"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set is a node and posts itself under each (coordinate, value) pair of
its MinHash signature; the documents that have the set follow it, and a document with several
texts joins its sets. A pair of sets is a candidate when at least ``threshold`` of the
``k`` coordinates collide. Values that only one set holds cannot collide, so a document
with fewer than ``threshold`` shared values drops out at once; of the others only the
``shared - threshold + 1`` rarest values need merging (prefix rule), which leaves the long
lists of common passages out (skip rule): those are only probed, by comparing signatures.
Links are confirmed on the full shingle sets.

Groups of near copies never expand into all pairs: in each star round every posting list
meets one centre, links are confirmed and contracted into components, and only lists that
still hold several components go on. After ``star_rounds`` the documents of the remaining
lists are compared exactly, in pairs of blocks, each task returning only the links that
connect components.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import cut, text_slices
from .words import WordHashes, mix, shingle_set

COORDINATES = 64
MATCHES = 32  # at similarity 0.75 a pair misses this with probability about 1e-5
STAR_ROUNDS = 2
BLOCK = 1 << 19  # shingles


def _factors(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sketches(width: int, k: int):
    """Arrow batches (id, text) -> (id, n_shingles, fp, sig)."""
    factors = _factors(k)

    def sketch(batches):
        hashes = WordHashes()
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(1), 1 << 20):
                sets = [shingle_set(t, hashes, width) for t in texts]
                full = [i for i, s in enumerate(sets) if len(s)]
                sig: list = [None] * len(sets)
                if full:
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
                    table = np.empty((len(full), k), dtype=np.uint64)
                    for j, a in enumerate(factors):
                        table[:, j] = np.minimum.reduceat(flat * a, starts)
                    for row, i in zip(table.view(np.int64), full, strict=True):
                        sig[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array(sig, pa.list_(pa.int64())),
                    ],
                    ["id", "n_shingles", "fp", "sig"],
                )

    return sketch


def _sets(width: int):
    """Arrow batches (rep, fp, text) -> (rep, members) of the texts whose set has that
    fingerprint."""

    def members(batches):
        hashes = WordHashes()
        for batch in batches:
            for lo, hi, texts in text_slices(batch.column(2), 1 << 20):
                sets = [shingle_set(t, hashes, width) for t in texts]
                own = batch.column(1).slice(lo, hi - lo).to_pylist()
                mine = pa.array([i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == own[i]], pa.int64())
                found = pa.array([sets[i].view(np.int64) for i in mine.to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(mine), found], ["rep", "members"])

    return members


def _collisions(a: str, b: str):
    return F.expr(f"size(filter(arrays_zip({a}, {b}), p -> p.{a} = p.{b}))")


def _block_links(similar: int, threshold: int):
    """Links between two blocks, confirmed on their full sets; ends that are connected
    already, by their components or by links found before, are not compared again."""

    def rows(part: pa.Table):
        sig = part["sig"].combine_chunks()
        sets = part["members"].combine_chunks()
        return (
            part["rep"].to_pylist(),
            part["comp"].to_pylist(),
            sig.flatten().to_numpy().reshape(len(sig), -1),
            np.diff(sets.offsets.to_numpy()),
            [sets[i].values.to_numpy().view(np.uint64) for i in range(len(sets))],  # sorted as unsigned numbers
        )

    def compare(table: pa.Table) -> pa.Table:
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        block = table["block"].to_numpy()
        left, right = table.filter(pa.array(block == lo)), table.filter(pa.array(block == hi))
        out_a, out_b = [], []
        if left.num_rows and right.num_rows:
            rep_l, comp_l, sig_l, n_l, set_l = rows(left)
            rep_r, comp_r, sig_r, n_r, set_r = rows(right)
            root = {c: c for c in [*comp_l, *comp_r]}

            def find(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            for i in range(len(rep_l)):
                near = np.flatnonzero(((sig_r == sig_l[i]).sum(axis=1) >= threshold) & (100 * np.minimum(n_r, n_l[i]) >= similar * np.maximum(n_r, n_l[i])))
                mine = find(comp_l[i])
                near = [j for j in near if find(comp_r[j]) != mine]
                if not near:
                    continue
                flat = np.concatenate([set_r[j] for j in near])
                at = np.minimum(np.searchsorted(set_l[i], flat), n_l[i] - 1)
                met = np.add.reduceat((set_l[i][at] == flat).astype(np.int64), np.cumsum([0] + [n_r[j] for j in near[:-1]]))
                for j, m in zip(near, met.tolist(), strict=True):
                    if 100 * m >= similar * int(n_l[i] + n_r[j] - m):
                        x, y = find(comp_l[i]), find(comp_r[j])
                        if x != y:
                            root[max(x, y)] = min(x, y)
                            out_a.append(rep_l[i])
                            out_b.append(rep_r[j])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return compare


def _blocks(live: DataFrame, nodes: DataFrame, sets: DataFrame, comps: DataFrame, block: int, similar: int, threshold: int) -> DataFrame:
    """Links between documents of different components that share a posting list.

    Documents joined by lists form clusters; a cluster is cut, in the order of its documents'
    first lists, into blocks of ``block`` shingles, and the pairs of blocks that share a list
    are compared, each by one task.
    """
    live = cut(live.select("token", "rep"), "near-live")
    hub = live.groupBy("token").agg(F.min("rep").alias("hub"))
    clusters = components(live.join(hub, "token").select(F.col("rep").alias("u"), F.col("hub").alias("v")), "near-clusters")
    first = live.groupBy("rep").agg(F.min("token").alias("first"))
    line = Window.partitionBy("cluster").orderBy("first", "rep")
    dealt = (
        first.join(clusters.select(F.col("node").alias("rep"), F.col("root").alias("cluster")), "rep")
        .join(nodes.select("rep", "n", "sig"), "rep")
        .select("rep", "cluster", F.floor(F.sum(F.col("n") + 256).over(line) / F.lit(block)).alias("block"))
    )
    dealt = cut(dealt, "near-dealt")
    met = live.join(dealt, "rep").select("token", "cluster", "block").distinct()
    wanted = met.select("token", "cluster", F.col("block").alias("lo")).join(met.select("token", F.col("block").alias("hi")), "token").filter("lo <= hi").select("cluster", "lo", "hi").distinct()
    wanted = cut(wanted, "near-wanted")
    full = dealt.join(comps, "rep").join(nodes.select("rep", "sig"), "rep").join(sets, "rep")
    visits = wanted.withColumn("block", F.explode(F.array_distinct(F.array("lo", "hi"))))
    return full.join(visits, ["cluster", "block"]).groupBy("cluster", "lo", "hi").applyInArrow(_block_links(similar, threshold), "a long, b long")


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, similar: int, threshold: int) -> DataFrame:
    """Pairs (a, b) whose signatures collide often enough and whose full sets are similar."""
    x, y = nodes.selectExpr("rep as a", "sig as sa", "n as na"), nodes.selectExpr("rep as b", "sig as sb", "n as nb")
    close = (
        pairs.join(x, "a")
        .join(y, "b")
        .filter(f"100 * least(na, nb) >= {similar} * greatest(na, nb)")
        .filter(_collisions("sa", "sb") >= threshold)
        .select("a", "b", "na", "nb")
    )
    both = close.join(sets.selectExpr("rep as a", "members as ma"), "a").join(sets.selectExpr("rep as b", "members as mb"), "b")
    met = F.size(F.array_intersect("ma", "mb")).cast("long")
    return both.withColumn("met", met).filter(f"100 * met >= {similar} * (na + nb - met)").select("a", "b")


def _contract(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after joining the ends of ``links`` (a, b)."""
    ends = links.join(comps.selectExpr("rep as a", "comp as u"), "a").join(comps.selectExpr("rep as b", "comp as v"), "b")
    roots = components(ends.select("u", "v"), "near-links")
    return cut(comps.join(roots, comps.comp == roots.node, "left").select("rep", F.coalesce("root", "comp").alias("comp")), "near-comps")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    similar: int = 75,
    k: int = COORDINATES,
    threshold: int = MATCHES,
    star_rounds: int = STAR_ROUNDS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Documents link when ``100 * |A & B| >= similar * |A | B|`` on their sets of distinct
    ``width``-word shingles. ``component_id`` is the smallest id reached over links.

    Null or wordless texts have an empty set and link with nothing. A text below ``width``
    words is one shingle. Equal sets always link. Rows with a null id link with nothing and
    come back with a null component, kept. Rows repeating an id are one document, which links
    by each of its texts; every row has its own text's ``n_shingles``. Very long texts count
    whole. Extra columns are ignored. An empty table gives an empty result.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "id long, n_shingles long, fp binary, sig array<long>"
    sketch = cut(given.mapInArrow(_sketches(width, k), kinds), "near-sketch")
    held = sketch.filter("fp is not null and id is not null")
    # a node for every distinct set: its number, and the smallest id that has it
    classes = cut(held.groupBy("fp").agg(F.min("id").alias("low")), "near-classes").withColumn("rep", F.monotonically_increasing_id())
    classes = cut(classes, "near-numbered")
    reps = sketch.join(classes.withColumnRenamed("low", "id"), ["fp", "id"]).dropDuplicates(["rep"]).selectExpr("rep", "id as low", "fp", "n_shingles as n", "sig")
    reps = cut(reps, "near-reps")

    posted = reps.select("rep", F.posexplode("sig").alias("j", "value")).select("rep", F.xxhash64("j", "value").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    lists = (
        posted.join(shared, "token")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("held", "token"))).alias("tokens"))
        .filter(F.size("tokens") >= threshold)
        .select("rep", F.explode(F.expr(f"slice(tokens, 1, size(tokens) - {threshold} + 1)")).alias("t"))
        .select("rep", "t.token")
    )
    posts = cut(lists, "near-posts")
    nodes = reps.join(posts.select("rep").distinct(), "rep", "left_semi")
    texts = given.join(nodes.select("rep", "fp", F.col("low").alias("id")), "id")
    sets = cut(texts.select("rep", "fp", "text").mapInArrow(_sets(width), "rep long, members array<long>").dropDuplicates(["rep"]), "near-sets")
    nodes = cut(nodes.select("rep", "n", "sig"), "near-nodes")

    comps = nodes.select("rep", F.col("rep").alias("comp"))
    tested: list[DataFrame] = []
    turn = 0
    while True:
        live = posts.join(comps, "rep")
        mixed = live.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("held"), F.min(F.struct(F.xxhash64("rep", F.lit(turn)), "rep", "comp")).alias("centre")).filter("c0 <> c1")
        if turn == star_rounds:
            links = cut(_blocks(live.join(mixed, "token", "left_semi"), nodes, sets, comps, block, similar, threshold), "near-found")
            comps = _contract(comps, links)
            break
        pairs = (
            live.join(mixed.select("token", "centre.rep", "centre.comp").toDF("token", "c", "c_comp"), "token")
            .filter("comp <> c_comp")
            .select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b"))
            .distinct()
        )
        if tested:
            pairs = pairs.join(reduce(DataFrame.union, tested), ["a", "b"], "left_anti")
        pairs = cut(pairs, "near-pairs")
        if pairs.isEmpty():
            turn = star_rounds
        else:
            tested.append(pairs)
            links = cut(_confirmed(pairs, nodes, sets, similar, threshold), "near-found")
            comps = _contract(comps, links)
            turn += 1
    # the sets of one document are joined, then each component has its smallest id
    named = cut(classes.join(comps, "rep", "left").select("fp", "low", F.coalesce("comp", "rep").alias("comp")), "near-named")
    several = held.groupBy("id").agg(F.min("fp").alias("fp0"), F.max("fp").alias("fp1")).filter("fp0 <> fp1").select("id")
    several = cut(held.join(several, "id").select("id", "fp").distinct(), "near-several")
    if not several.isEmpty():
        own = several.join(named.select("fp", "comp"), "fp")
        hub = own.groupBy("id").agg(F.min("comp").alias("hub"))
        roots = components(own.join(hub, "id").select(F.col("comp").alias("u"), F.col("hub").alias("v")), "near-joined")
        named = cut(named.join(roots, named.comp == roots.node, "left").select("fp", "low", F.coalesce("root", "comp").alias("comp")), "near-named")
    lows = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    group = cut(named.join(lows, "comp").select(F.col("fp").alias("class_fp"), "component_id"), "near-groups")
    linked = sketch.select("id", "n_shingles", "fp").join(group, (F.col("fp") == F.col("class_fp")) & F.col("id").isNotNull(), "left")
    return linked.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
