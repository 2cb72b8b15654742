"""The contract queries over the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .bytepairs import encode_byte_pairs
from .lsh import multiprobe_neighbours
from .mixing import pareto_mix
from .neardup import near_duplicates
from .pieces import encode_documents
from .quality import quality_scores
from .repair import damage, repair_report
from .ring import bounded_ring
from .topk import histogram_top_k
from .suffixes import remove_repeats
from .toxicity import toxicity_scores
from .trie import prefix_trie, rebuilt
from .urls import template_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query
def op1_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_filter(_table(spark, sf_dir, "pages"), RULES)


@query
def op2_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(_table(spark, sf_dir, "documents")).drop("tie", "number")


@query
def op4_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query
def op5_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = bounded_ring(_table(spark, sf_dir, "documents"), shards=8)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


@query
def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op8_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def piece_model() -> str:
    """Place of the public merge-type vocabulary, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op9_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"), piece_model())


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op11_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations")
    return repair_report(damage(convs), ids=convs)


@query
def op12_byte_pair_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_byte_pairs(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(_table(spark, sf_dir, "conversations")))


ORACLES |= {
    "op1_path_templates": oracles.url_filter(RULES),
    "op3_pareto_mix": oracles.MIX,
    "op4_histogram_top_k": oracles.TOP_K,
    "op6_suffix_array_dedup": oracles.REPEATS,
    "op10_minhash_near_dedup": oracles.NEAR,
    "op11_viterbi_repair": oracles.REPAIR,
    "op13_prefix_trie": oracles.TRIE,
}
