"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by its weight, capped at ``max_repeats`` times its own
words; what exceeds a cap is shared again among the others by weight. A source whose target
is r times its words takes every document floor(r) times for certain. The rest is a
fixed-size sample: each document draws a random number u by its id (without an id, by its
text; rows that are equal in all, each by its number), and documents are ranked
by the random odds u / (1 - u) divided by their inclusion odds p / (1 - p), p = r - floor(r).
The sample is the head of that ranking, cut where its words come nearest to what is missing;
then one more document, the one nearest to what is still missing, may close the gap.

The cut is found in two steps, so that no task sorts a source: words are summed in
``buckets`` slices of the ranking per source, and only the slice with the cut is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUCKETS = 1 << 12


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size): the water level of the capped shares.

    The table has one row per source; ``weights`` repeat over the sources in code-point order,
    null last.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * max_repeats)
    # in the order in which sources fill up, the level that is left over rises until it is reached
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = F.max((total - full) / rest).over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.withColumn("target", F.least("cap", level * F.col("weight"))).select("source", "source_size", "target")


def pareto_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_repeats: int = 3,
    seed: int = 7,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: ``id_col``, ``source``, ``size``, ``source_size``, ``target``,
    ``copies`` (0 to ``max_repeats``), ``taken`` (``copies * size``), ``tie`` and ``number``.

    A size is the number of words; a null or wordless text has size 0 and is taken whole
    copies only. A null source is a source of its own, the last one. Rows without an id, with a
    repeated id or equal in all are documents of their own; ``tie`` (a hash of the text) and
    ``number`` (from 1) tell them apart. Ties rank by id, size, tie and number. Very long
    texts count whole. Extra columns are ignored; an empty table gives an empty result.
    Reruns agree.
    """
    sized = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("tie"),
    )
    # rows that are equal in all are counted, then numbered
    sized = sized.groupBy("id", "source", "size", "tie").agg(F.count(F.lit(1)).alias("held"))
    sized = sized.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("held")))).drop("held")
    own = F.when(F.col("id").isNull(), F.concat(F.lit("null:"), F.col("tie").cast("string"), F.lit(":"), F.col("number").cast("string")))
    own = own.when(F.col("number") > 1, F.concat(F.col("id").cast("string"), F.lit(":"), F.col("number").cast("string"))).otherwise(F.col("id").cast("string"))
    draw = F.conv(F.substring(F.md5(F.concat(own, F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double")
    sized = cut(sized.withColumn("u", (draw + 0.5) / float(1 << 52)), "mix-sizes")
    targets = source_targets(sized, weights, max_repeats)
    targets = targets.withColumn("repeats", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    targets = targets.withColumn("whole", F.floor("repeats")).withColumn("p", F.col("repeats") - F.col("whole"))
    targets = cut(targets.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    odds = F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
    ranked = sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("odds", odds)
    ranked = ranked.withColumn("slice", F.floor(F.col("odds") / (1 + F.col("odds")) * buckets))

    words = ranked.filter("odds is not null").groupBy("source", "missing", "slice").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("slice")
    # the slices whose words, from the head of the ranking on, reach what is missing
    steps = words.withColumn("before", F.sum("words").over(so_far) - F.col("words"))
    edge = steps.filter("before <= missing").groupBy("source").agg(F.max(F.struct("slice", "before")).alias("e")).select(F.col("source").alias("of"), F.col("e.slice").alias("edge"), F.col("e.before").alias("before"))
    ranked = ranked.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")

    head = ranked.withColumn("drawn", F.when(F.col("slice") < F.col("edge"), 1).otherwise(0)).filter("slice is null or edge is null or slice <> edge")
    order = Window.partitionBy("source").orderBy("odds", "id", "size", "tie", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_edge = ranked.filter("slice = edge").withColumn("upto", F.col("before") + F.sum("size").over(order))
    at_edge = at_edge.withColumn("drawn", F.when(F.col("upto") - F.col("size") / 2 <= F.col("missing"), 1).otherwise(0)).drop("upto")
    drawn = cut(head.unionByName(at_edge).select("id", "source", "size", "tie", "number", "odds", "source_size", "target", "whole", "missing", "drawn"), "mix-drawn")

    gap = drawn.groupBy("source", "missing").agg((F.col("missing") - F.sum(F.col("drawn") * F.col("size"))).alias("gap")).select(F.col("source").alias("of"), "gap")
    off = F.abs(F.col("size") - F.abs("gap"))
    turn = F.when(F.col("gap") > 0, F.col("drawn") == 0).otherwise(F.col("drawn") == 1)
    near = drawn.join(gap, F.col("source").eqNullSafe(F.col("of"))).filter(turn & (off < F.abs("gap")) & F.col("odds").isNotNull())
    one = F.struct("odds", "id", "size", "tie", "number")
    last = near.groupBy("source").agg(F.min(F.struct(off.alias("off"), one.alias("one"))).alias("c")).select(F.col("source").alias("of"), F.col("c.one").alias("closing"))
    closing = F.coalesce(F.col("closing").eqNullSafe(one) & F.col("closing").isNotNull(), F.lit(False))
    copies = F.col("whole") + F.when(closing, 1 - F.col("drawn")).otherwise(F.col("drawn"))
    return (
        drawn.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("copies", copies.cast("long"))
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tie", "number")
    )
