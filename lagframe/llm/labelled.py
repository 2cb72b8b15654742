"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``."""
    crc = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    return F.coalesce(crc % parts == part, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, parts: int, part: int, limit: int, seed: int = 3) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents that are not held out, picked by
    a hash of their id. Null labels, labels other than 0 and 1 and null ids are left out; of
    an id's several labels the larger counts, of its several texts the one with the smallest
    hash. The picked ids, ``limit`` at most, are broadcast.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)").filter(~held_out("id", parts, part)).groupBy("id").agg(F.max("label").alias("label"))
    picked = known.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(limit)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    labelled = texts.join(F.broadcast(picked), "id")
    one = labelled.groupBy("id").agg(F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text")).alias("one"))
    return one.select("one.text", "one.label")
