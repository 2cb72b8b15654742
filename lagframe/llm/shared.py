"""Small helpers of the operators: shared-folder tables that cut lineage, and Arrow access."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


_MADE: list[list[str]] = []  # paths of the recordings that are open, innermost last


@contextmanager
def recording(paths: list[str]):
    """Note the tables that ``cut`` writes meanwhile in ``paths``."""
    _MADE.append(paths)
    try:
        yield
    finally:
        _MADE.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete recorded tables whose readers have all been run."""
    while paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below ``spark.checkpoint.dir`` and read it back: a lineage
    cut that survives lost executors and is computed once."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b if b is not None else b"" for b in column.cast(kind).to_pylist()]


def text_slices(column: pa.Array, limit: int):
    """(first row, row behind the last, UTF-8 bytes of the rows) for slices of about ``limit``
    bytes, so that only one slice at a time is held besides the Arrow batch."""
    for lo, hi in runs(pc.binary_length(column).fill_null(0).to_pylist(), limit):
        yield lo, hi, utf8(column.slice(lo, hi - lo))


def runs(sizes, limit: int):
    """Consecutive index ranges whose sizes add up to about ``limit`` (one item at least)."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
