"""URL filter: rules first, then a tree of path templates per host.

Rules of (verdict, host, path) judge the urls they fit; these urls are the labels from which
the others are judged. Level by level the path segments below a node of a host's tree stay
as they are if they are frequent there, and become the wildcard ``*`` if not; what lies below
``depth`` levels becomes ``**``. Branches below one node whose labels do not differ from the
node's by a z-test merge: they are judged by their common counts. These are compared with the
same template over all hosts: branches that do not differ from it, or have no labels of their
own, go by the pooled branch. A template is rejected if its share of blocked labels, smoothed
towards the pooled share (and that towards the share of all), is at least ``reject_at``. One
without a label on any host is allowed, and so is one of wildcards alone without a label on its
own host: it says nothing about the path.

Everything is DataFrame expressions. Counting collapses in partial aggregates, and rows meet
the frequent segments of their node, at most ``1 / min_share`` of them, in an equi-join.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

ADDRESS = "(?s)^.*?://([^/?#]*)([^?#]*)"
DEPTH, MIN_SHARE, MIN_COUNT = 3, 0.05, 5
STRENGTH, Z, REJECT_AT = 4.0, 1.96, 0.75


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, ADDRESS, 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def fitting_rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, at, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        rule, verdict = F.when(fits, F.lit(at + below)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def template_filter(
    pages: DataFrame,
    rules,
    id_col: str = "page_id",
    url_col: str = "url",
    depth: int = DEPTH,
    min_share: float = MIN_SHARE,
    min_count: int = MIN_COUNT,
    strength: float = STRENGTH,
    z: float = Z,
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """One row per page: ``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``template``.

    A null url, or one without ``://``, has an empty host and path and is judged by them.
    ``rule`` is null where none fits; of rules of one length that fit, the last given counts.
    Without any labels nothing is rejected. Very long urls are matched whole, with segments
    beyond ``depth`` as one wildcard. Null and repeated ids and repeated urls are rows of
    their own. Extra columns are ignored; an empty table gives an empty result.
    """
    url = F.col(url_col).cast("string")
    seen = pages.select(F.col(id_col).cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = fitting_rule(rules, F.col("host"), F.col("path"))
    seen = seen.withColumn("rule", rule).withColumn("ruled", verdict)

    tree = seen.groupBy("host", "path", "ruled").agg(F.count("*").alias("n"))
    tree = tree.withColumn("parts", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    for level in range(depth):
        tree = cut(tree.withColumn("segment", F.get("parts", F.lit(level))), "url-level")
        below = tree.filter("segment is not null").groupBy("host", "template", "segment").agg(F.sum("n").alias("held"))
        whole = below.groupBy("host", "template").agg(F.sum("held").alias("all"))
        frequent = below.join(whole, ["host", "template"]).filter((F.col("held") >= min_count) & (F.col("held") >= min_share * F.col("all")))
        frequent = frequent.select("host", "template", "segment", F.col("segment").alias("stays"))
        tree = tree.join(frequent, ["host", "template", "segment"], "left")
        tree = tree.withColumn("template", F.when(F.col("segment").isNotNull(), F.concat("template", F.lit("/"), F.coalesce("stays", F.lit("*")))).otherwise(F.col("template"))).drop("segment", "stays")
    tree = cut(tree.withColumn("template", F.when(F.size("parts") > depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))), "url-tree")

    labels = tree.groupBy("host", "template").agg(
        F.sum(F.when(F.col("ruled").isNotNull(), F.col("n")).otherwise(0)).alias("known"), F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("blocked")
    )
    total = labels.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("k"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")).first()
    share = (total["b"] + strength * 0.5) / (total["k"] + strength)
    pooled = labels.groupBy("template").agg(
        F.sum("known").alias("met"), ((F.sum("blocked") + F.lit(strength * share)) / (F.sum("known") + F.lit(strength))).alias("pooled")
    )

    def differs(blocked: Column, known: Column, share_: Column) -> Column:
        return F.abs(blocked - known * share_) >= z * F.sqrt(known * share_ * (1 - share_))

    # branches below one node that are alike are judged by their common counts
    branches = labels.withColumn("node", F.regexp_replace("template", "/[^/]*$", ""))
    nodes = branches.groupBy("host", "node").agg(F.sum("known").alias("all"), F.sum("blocked").alias("bad"))
    branches = branches.join(nodes, ["host", "node"])
    mixed = (F.col("bad") > 0) & (F.col("bad") < F.col("all"))  # else all labels below the node agree
    alone = (F.col("known") == 0) | (mixed & differs(F.col("blocked"), F.col("known"), F.col("bad") / F.greatest("all", F.lit(1))))
    branches = branches.withColumn("alike", ~alone)
    common = branches.filter("alike").groupBy("host", "node").agg(F.sum("known").alias("k"), F.sum("blocked").alias("b"))
    branches = branches.join(common, ["host", "node"], "left")
    branches = branches.select("host", "template", F.when(F.col("alike"), F.col("k")).otherwise(F.col("known")).alias("known"), F.when(F.col("alike"), F.col("b")).otherwise(F.col("blocked")).alias("blocked"))

    judged = branches.join(pooled, "template")
    own = (F.col("blocked") + strength * F.col("pooled")) / (F.col("known") + strength)
    told = (F.col("known") > 0) | ((F.col("met") > 0) & F.col("template").rlike("[^/*]"))
    purity = F.when((F.col("known") > 0) & differs(F.col("blocked"), F.col("known"), F.col("pooled")), own).when(told, F.col("pooled"))
    judged = judged.withColumn("purity", F.coalesce(purity, F.lit(0.0)))
    found = tree.select("host", "path", "template").distinct().join(judged.select("host", "template", "purity"), ["host", "template"])
    found = found.select("host", "path", "template", F.when(F.col("purity") >= reject_at, "block").otherwise("allow").alias("method"))
    return seen.join(found, ["host", "path"]).select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", "method").alias("verdict"), "template")
