"""Incremental landed-CSV ingest with Structured Streaming (A1 -> A6 as a stream).

``readStream`` over the landed folder (partition columns geocode/year come from the
paths), ``foreachBatch`` runs the same parse / place join / append as the batch
path, and ``trigger(availableNow=True)`` processes everything that has landed and
stops. The checkpoint (below the shared ``spark.checkpoint.dir``) records processed
files, so a rerun loads only new files; a batch replayed after a failure appends
rows with a newer load time, which ``dedup_latest`` resolves.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import YEAR_BOUNDS
from ..sources.landed import CASE_FILE_SCHEMA, CORRUPT, _places_frame, parse_case_files
from ..sources.tables import Store


def stream_case_files(
    spark: SparkSession,
    root: str,
    store: Store,
    places: Mapping[str, int] | DataFrame,
    checkpoint: str,
    year_bounds: tuple[int, int] = YEAR_BOUNDS,
    max_files_per_trigger: int | None = None,
    rejects: str | None = None,
) -> int:
    """Load every not-yet-seen landed case file into ``store``; returns rows appended.

    Lines that do not fit are appended to the parquet folder ``rejects`` (default: beside
    the checkpoint), with their file and batch.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, geocode int, year int")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(root).select("content", "geocode", "year", F.col("path").alias("file"))
    bad = rejects or checkpoint.rstrip("/") + "-rejects"
    pl = _places_frame(spark, places)
    appended = []

    def load(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_case_files(batch, CASE_FILE_SCHEMA, year_bounds).join(pl, "geocode").persist()
        try:
            rows = parsed.filter("_ok").select("geocode", "place", F.col("se").cast("int").alias("se"), "cases", "cases_est", "level", "incidence")
            appended.append(store.append_cases(rows))
            wrong = parsed.filter(~F.col("_ok")).select("geocode", "place", "year", "se", CORRUPT, "file", F.lit(batch_id).alias("batch"))
            wrong.write.mode("append").parquet(bad)
        finally:
            parsed.unpersist()

    q = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(appended)
