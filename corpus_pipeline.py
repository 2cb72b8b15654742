"""A training-corpus pipeline over ``documents``, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All but
the last stage return the columns of ``documents``. Each stage works on all that its
predecessor kept. Near-dedup and mixing decide row by row, also if ids are missing or
repeated.

A stage's own tables below ``spark.checkpoint.dir`` go when the next stage begins, whose
``docs`` are read from the written Parquet.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagframe.llm.mixing import pareto_mix
from lagframe.llm.neardup import near_duplicates
from lagframe.llm.pieces import encode_documents
from lagframe.llm.quality import quality_filter
from lagframe.llm.queries import piece_model
from lagframe.llm.shared import cut, recording, release
from lagframe.llm.suffixes import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_LEFT: list[str] = []  # tables of the stage that ran last


def stage(fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _LEFT)
        with recording(_LEFT):
            return fn(spark, docs, sf_dir)

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores below one half go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_filter(docs.select(*COLUMNS), labels)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the smallest id stays, one without an
    id only if there is no other. Each row is a document of its own, also if ids are missing
    or repeated; of equal rows one stays. Wordless texts link with nothing and stay."""
    rows = cut(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    near = cut(near_duplicates(rows, id_col="row").select("row", "component_id"), "pipeline-near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    best = near.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(first.alias("best"))
    gone = near.select("row").join(best.select("best.row"), "row", "left_anti")
    return rows.join(cut(gone, "pipeline-gone"), "row", "left_anti").select(*COLUMNS)


@stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that start in more than one place; a character that
    a cut splits goes as a whole. Texts may become empty; their documents stay."""
    left = remove_repeats(docs, keep_text=True, carry=("lang", "source"))
    return left.withColumnRenamed("kept", "text").withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, from never to three times."""
    tie = F.xxhash64("text").alias("tie")
    alike = Window.partitionBy("doc_id", "source", "tie").orderBy("lang", "n_chars")
    rows = docs.select(*COLUMNS, tie).withColumn("number", F.row_number().over(alike))
    copies = pareto_mix(docs).filter("copies > 0").select(*[F.col(c).alias(f"of_{c}") for c in ("doc_id", "source", "tie", "number")], "copies")
    same = (F.col("tie") == F.col("of_tie")) & (F.col("number") == F.col("of_number"))
    taken = rows.join(copies, same & F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & F.col("source").eqNullSafe(F.col("of_source")))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return encode_documents(docs, piece_model())


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", repeats),
    ("mixing to target weights", mix),
    ("sentencepiece coding", encode),
]

#: the first stage trains a classifier, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline: every stage on all that its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = cut(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    release(spark, _LEFT)
    return docs
