"""Landed-file ingest: weekly case CSVs (A1, A2), CSV result sinks (A14, A15),
and JSON payloads with parallel daily arrays (A3).

Network collection is out of scope: files are expected to have landed under a
root folder partitioned as ``geocode=<code>/year=<yyyy>/*.csv``. Partition
discovery plus the filters on code and year prune whole folders before any file
is opened. Columns are found by name; lines that do not fit go to a reject frame
instead of failing the job, so that rows and rejects together are all lines read.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import YEAR_BOUNDS, parse_yearweek

CORRUPT = "_corrupt_record"

# Column layout of a landed weekly case file (header row, comma separated).
CASE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("se", T.StringType()),
        T.StructField("cases", T.LongType()),
        T.StructField("cases_est", T.DoubleType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("incidence", T.DoubleType()),
    ]
)


def land_case_csv(df: DataFrame, root: str, code_col: str = "geocode", year_col: str = "year") -> None:
    """Write weekly rows as landed CSV files partitioned by (geocode, year); rows of one
    folder are brought together first, so that a folder gets one file."""
    cols = [f.name for f in CASE_FILE_SCHEMA.fields]
    (
        df.select(F.col(code_col).alias("geocode"), F.col(year_col).alias("year"), *cols)
        .repartition("geocode", "year")
        .write.mode("overwrite")
        .partitionBy("geocode", "year")
        .option("header", True)
        .csv(root)
    )


BLOCK = 1 << 24  # bytes of a file that are parsed at a time, so the longest record


def _records(content: bytes, names: list[str]):
    """Arrow tables (whether whole, raw text, the named fields) of one file's records.

    The first record that is not blank is the header. Quoted fields may hold commas, doubled
    quotes and line breaks. Records of another length than the header, and all lines of a file
    whose header lacks a name, are not whole and have no fields."""
    columns = ["whole", "raw", *names]
    rest = io.TextIOWrapper(io.BytesIO(content), "utf-8-sig", "replace", newline="")
    header = [f.strip() for f in next((r for r in csv.reader(rest) if any(f.strip() for f in r)), [])]

    def broken(texts):
        texts = [t for t in (t.strip("\r\n") for t in texts) if t.strip()]
        return pa.table([pa.array([False] * len(texts)), pa.array(texts, pa.string()), *[pa.nulls(len(texts), pa.string())] * len(names)], columns)

    if not set(names) <= set(header):
        yield broken(content.decode("utf-8-sig", "replace").splitlines())
        return
    odd: list[str] = []
    parse = pcsv.ParseOptions(newlines_in_values=True, invalid_row_handler=lambda row: odd.append(row.text) or "skip")
    read = pcsv.ReadOptions(column_names=[str(i) for i in range(len(header))], block_size=BLOCK, use_threads=False)
    strings = pcsv.ConvertOptions(column_types={str(i): pa.string() for i in range(len(header))}, strings_can_be_null=False, check_utf8=False)
    skip = 1  # the header comes as the first row
    for batch in pcsv.open_csv(pa.BufferReader(content), read, parse, strings):
        batch, skip = batch.slice(skip), max(0, skip - batch.num_rows)
        if batch.num_rows:
            yield pa.table([pa.array([True] * batch.num_rows), _joined(batch.columns), *[batch.column(header.index(n)) for n in names]], columns)
    yield broken(odd)


def _joined(fields: list[pa.Array]) -> pa.Array:
    """Fields as a CSV line, quoted where they must be."""
    out = []
    for f in fields:
        special = pc.match_substring_regex(f, '[",\r\n]')
        if special.true_count:
            quoted = pc.binary_join_element_wise('"', pc.replace_substring(f, '"', '""'), '"', "")
            f = pc.if_else(special, quoted, f)
        out.append(f)
    return pc.binary_join_element_wise(*out, ",")


def _parse(names: list[str], carried: list[str]):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                beside = [batch.column(c)[i] for c in carried]
                for table in _records(batch.column("content")[i].as_py() or b"", names):
                    if table.num_rows:
                        given = [pa.repeat(v, table.num_rows) for v in beside]
                        yield from pa.table([*given, *table.columns], [*carried, *table.column_names]).to_batches()

    return run


def parse_case_files(files: DataFrame, schema: T.StructType = CASE_FILE_SCHEMA, year_bounds: tuple[int, int] = YEAR_BOUNDS) -> DataFrame:
    """Case files (``content`` and columns to carry along) -> their records with the columns of
    ``schema``, ``_y``, ``_w`` and ``_ok``.

    A file is read once, by one task, from its header on, so that quoted line breaks are never
    cut and no line is shuffled to find its header; the files of a partition are parsed one
    after the other, ``BLOCK`` bytes at a time. Columns are found by the names in the header,
    in any order and among others. A record is not ok if its file's header lacks a name of
    ``schema``, it has another number of fields than the header, a value does not convert, or
    its week code is invalid; it then keeps its text. Blank lines and headers are no records.
    """
    names = [f.name for f in schema.fields]
    carried = [c for c in files.columns if c != "content"]
    kinds = ", ".join([*(f"`{c}` {files.schema[c].dataType.simpleString()}" for c in carried), "whole boolean, raw string", *(f"`{n}` string" for n in names)])
    data = files.mapInArrow(_parse(names, carried), kinds)
    values, fits = {}, F.col("whole")
    for f in schema.fields:
        text = F.trim(f.name)
        text = F.when(text != "", text)
        values[f.name] = text.try_cast(f.dataType)
        fits = fits & (text.isNull() | values[f.name].isNotNull())
    y, w, ok = parse_yearweek(values["se"], year_bounds)
    return data.withColumns({**values, "_y": y, "_w": w, "_ok": fits & ok}).withColumn(CORRUPT, F.when(~F.col("_ok"), F.col("raw"))).drop("whole", "raw")


PRUNED = 1000  # so many codes at most go into the folder filter


def _places_frame(spark: SparkSession, places) -> DataFrame:
    if isinstance(places, DataFrame):
        return places.select(F.col("place").cast("string"), F.col("geocode").cast("int"))
    if not places:
        raise ValueError("the place map must not be empty")
    schema = T.StructType([T.StructField("place", T.StringType()), T.StructField("geocode", T.IntegerType())])
    return spark.createDataFrame([(k, int(v)) for k, v in places.items()], schema)


def ingest_case_csv(
    spark: SparkSession,
    root: str,
    places: Mapping[str, int] | DataFrame,
    year_from: int,
    year_to: int,
    schema: T.StructType = CASE_FILE_SCHEMA,
    year_bounds: tuple[int, int] = YEAR_BOUNDS,
) -> tuple[DataFrame, DataFrame]:
    """Read landed weekly case files for the given places and inclusive year range (A1, A2).

    Returns (rows, rejects), which together hold every data line. rows carry ``place`` and
    ``geocode`` from the place map plus the parsed (year, week) of ``se``; rejects hold the
    records that ``parse_case_files`` does not accept. Missing years, places or the whole root
    contribute no files.
    """
    if year_from > year_to:
        raise ValueError(f"year_from ({year_from}) must be <= year_to ({year_to})")
    none = spark.createDataFrame([], "content binary, geocode int, year int")
    try:
        files = spark.read.format("binaryFile").option("basePath", root).load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = none
    files = files if {"geocode", "year"} <= set(files.columns) else none  # a root without folders
    files = files.select("content", F.col("geocode").cast("int"), F.col("year").cast("int")).filter(F.col("year").between(year_from, year_to))
    if isinstance(places, Mapping) and len(places) <= PRUNED:
        files = files.filter(F.col("geocode").isin([int(v) for v in places.values()]))
    pl = _places_frame(spark, places)
    parsed = parse_case_files(files, schema, year_bounds).join(pl, "geocode")  # the planner sizes the place dimension
    rows = parsed.filter("_ok").select(
        "geocode",
        "place",
        F.col("se").cast("int").alias("se"),
        F.col("_y").alias("year"),
        F.col("_w").alias("week"),
        *[f.name for f in schema.fields if f.name != "se"],
    )
    rejects = parsed.filter(~F.col("_ok")).select("geocode", "place", "year", "se", CORRUPT)
    return rows, rejects


def ingest_summary(rows: DataFrame) -> DataFrame:
    """Row count and number of distinct places of an ingest (A2)."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("place").alias("places"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV result sink with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV result back with an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


# ------------------------------------------------------------------ A3 JSON parallel arrays
def payload_schema(variables: Sequence[str]) -> T.StructType:
    daily = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    )
    return T.StructType(
        [
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("daily", daily),
        ]
    )


def explode_daily_payload(df: DataFrame, variables: Sequence[str], keys: Sequence[str] = (), payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """One row per day from a payload whose ``daily`` object holds parallel arrays (A3).

    Payloads that are not JSON, lack ``daily``, or whose arrays differ in length go
    to the reject frame (``arrays_zip`` would silently pad the short ones).
    Returns (rows: keys, latitude, longitude, day, variables...; rejects).
    """
    keys = list(keys)
    p = df.withColumn("_p", F.from_json(F.col(payload_col), payload_schema(variables)))
    sizes = [F.size(F.col(f"_p.daily.{v}")) for v in variables]
    n = F.size(F.col("_p.daily.time"))
    same = F.lit(True)
    for s in sizes:
        same = same & (s == n)
    ok = F.col("_p.daily").isNotNull() & F.col("_p.daily.time").isNotNull() & F.coalesce(same, F.lit(False))
    p = p.withColumn("_ok", ok)
    good = p.filter("_ok").select(
        *keys,
        F.col("_p.latitude").alias("latitude"),
        F.col("_p.longitude").alias("longitude"),
        F.inline(F.arrays_zip(F.col("_p.daily.time").alias("time"), *[F.col(f"_p.daily.{v}").alias(v) for v in variables])),
    )
    rows = good.select(*keys, "latitude", "longitude", F.to_date("time").alias("day"), *variables)
    rejects = p.filter(~F.col("_ok")).select(*keys, payload_col)
    return rows, rejects


def to_daily_payload(daily: DataFrame, variables: Sequence[str], keys: Sequence[str], day_col: str = "day") -> DataFrame:
    """Inverse of explode_daily_payload: one JSON document per group with parallel arrays,
    days in order (used to land test payloads). Groups are bounded by the calendar."""
    keys = list(keys)
    g = daily.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(day_col).cast("string").alias("t"), *variables))).alias("_d"))
    obj = F.struct(
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.struct(F.col("_d.t").alias("time"), *[F.col(f"_d.{v}").alias(v) for v in variables]).alias("daily"),
    )
    return g.select(*keys, F.to_json(obj).alias("payload"))
