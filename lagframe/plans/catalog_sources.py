"""Registered source/sink/table queries (A1-A3, A5-A10, A12-A15) and their oracles.

Each callable lands or writes its data under a fresh folder below the shared
checkpoint root (never a machine-local temp dir), reads it back and returns the
read-back frame; the oracle computes the expected rows from the raw tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import correlation as C
from ..operators.lagjoin import lag_join
from ..sources import landed as L
from ..sources.tables import LOADED_AT, Store, co_located, dedup_latest
from ..session import scratch_path
from . import oracle as O
from . import views as V
from .catalog import LAGS, REGION, dsql, register, rounded, rsql

_CASE_OUT = ["geocode", "place", "se", "year", "week", "cases", "cases_est", "level", "incidence"]
_CASE_SQL = f"SELECT geocode, region AS place, se, year, week, cases, {rsql('cases_est')}, level, {rsql('incidence')} FROM cases"


# the test weeks start in 1995, below the default 2000 floor of the week-code parser
YEAR_BOUNDS = (1990, 2100)


def _store(spark, tag: str, **layout) -> Store:
    s = Store(spark, scratch_path(spark, tag), prefix=f"lf_{uuid.uuid4().hex[:12]}_", year_bounds=YEAR_BOUNDS, **layout)
    s.create_schema()
    return s


def _kept(s: Store, name: str):
    """The table's rows; the tables leave the session catalog, their files stay."""
    df = s.table(name)
    s.drop()
    return df


def _places(spark, d):
    return V.table(spark, d, "region").select(F.col("r_name").alias("place"), F.col("r_regionkey").alias("geocode"))


def _landed_cases(spark, d):
    root = scratch_path(spark, "landed-cases")
    c = V.cases_t(spark, d).withColumn("se", F.col("se").cast("string"))
    L.land_case_csv(c, root)
    return L.ingest_case_csv(spark, root, _places(spark, d), *_years(c), year_bounds=YEAR_BOUNDS)


def _years(cases) -> tuple[int, int]:
    """First and last year of the cases."""
    return tuple(cases.agg(F.min("year"), F.max("year")).first())


# ------------------------------------------------------------------ A1 / A2
@register("ingest_case_csv", O.build(_CASE_SQL, "cases"))
def q_ingest_case_csv(spark, d):
    rows, _rejects = _landed_cases(spark, d)
    return rounded(rows.select(*_CASE_OUT))


@register(
    "ingest_many",
    O.build("SELECT count(*) AS rows, count(DISTINCT region) AS places FROM cases", "cases"),
)
def q_ingest_many(spark, d):
    rows, _rejects = _landed_cases(spark, d)
    return L.ingest_summary(rows)


# weeks land in three kinds of file: as usual, with columns in another order and one more that
# holds commas, quotes and line breaks, and
# with values that do not convert or a week code that is none
_KIND = "CASE WHEN week % 3 = 0 THEN 0 WHEN week % 3 = 1 THEN 1 ELSE 2 END"


@register(
    "ingest_odd_files",
    O.build(
        f"SELECT geocode, count(*) FILTER (kind < 2) AS rows, sum(cases) FILTER (kind < 2)::BIGINT AS cases, {O.rnd('sum(CAST(incidence AS DECIMAL(20, 9))) FILTER (kind < 2)')} AS incidence, "
        f"count(*) FILTER (kind = 2) AS rejects FROM (SELECT *, {_KIND} AS kind FROM cases) GROUP BY geocode",
        "cases",
    ),
)
def q_ingest_odd_files(spark, d):
    """Records by column name; rows and rejects together are all records."""
    root = scratch_path(spark, "landed-odd")
    cols = [f.name for f in L.CASE_FILE_SCHEMA.fields]
    cases = V.cases_t(spark, d).withColumn("kind", F.expr(_KIND)).select("kind", "geocode", "year", *[F.col(c).cast("string").alias(c) for c in cols])
    odd = cases.filter("kind = 2")
    wrong = odd.withColumns({"se": F.when(F.col("year") % 2 == 0, F.lit("2024x1")).otherwise(F.col("se")), "cases": F.when(F.col("year") % 2 == 1, F.lit("many")).otherwise(F.col("cases"))})
    files = [cases.filter("kind = 0"), cases.filter("kind = 1").select("geocode", "year", F.lit('a,\n"b"').alias("note"), *cols[::-1]), wrong]
    for part in files:
        part.drop("kind").repartition("geocode", "year").write.mode("append").partitionBy("geocode", "year").option("header", True).option("escape", '"').csv(root)
    rows, rejects = L.ingest_case_csv(spark, root, _places(spark, d), *_years(cases), year_bounds=YEAR_BOUNDS)
    both = rows.select("geocode", "cases", F.col("incidence").cast("decimal(20,9)").alias("incidence"), F.lit(1).alias("ok")).unionByName(
        rejects.select("geocode", F.lit(None).cast("long").alias("cases"), F.lit(None).cast("decimal(20,9)").alias("incidence"), F.lit(0).alias("ok"))
    )
    out = both.groupBy("geocode").agg(
        F.sum("ok").alias("rows"), F.sum("cases").alias("cases"), F.sum("incidence").cast("double").alias("incidence"), F.sum(1 - F.col("ok")).alias("rejects")
    )
    return rounded(out)


# ------------------------------------------------------------------ A3 JSON parallel arrays
@register(
    "json_arrays_to_rows",
    O.build(f"SELECT region, {dsql('day')}, " + ", ".join(rsql(v) for v in V.DAILY_VARS) + " FROM daily", "daily"),
)
def q_json_arrays_to_rows(spark, d):
    daily = V.daily(spark, d).withColumn("year", F.year("day"))
    path = scratch_path(spark, "payloads")
    L.to_daily_payload(daily, V.DAILY_VARS, ["region", "year"]).write.mode("overwrite").json(path)
    landed = spark.read.schema("region STRING, year INT, payload STRING").json(path)
    rows, _rejects = L.explode_daily_payload(landed, V.DAILY_VARS, keys=["region"])
    return rounded(rows.select("region", "day", *V.DAILY_VARS))


# ------------------------------------------------------------------ A5-A10 appends
@register("append_cases", O.build(_CASE_SQL, "cases"))
def q_append_cases(spark, d):
    s = _store(spark, "store-cases")
    s.append_cases(V.cases_t(spark, d).withColumnRenamed("region", "place"))
    return rounded(_kept(s, "cases_raw").select(*_CASE_OUT))


LAT, LON = -23.42, -51.93


@register(
    "append_daily",
    O.build(
        f"SELECT CAST({LAT} AS DOUBLE) AS latitude, CAST({LON} AS DOUBLE) AS longitude, {dsql('day')}, "
        + ", ".join(rsql(v) for v in V.DAILY_VARS)
        + " FROM daily_all",
        "daily_all",
    ),
)
def q_append_daily(spark, d):
    s = _store(spark, "store-daily")
    s.append_daily(V.daily_all(spark, d), LAT, LON)
    return rounded(_kept(s, "daily_climate").drop(LOADED_AT))


@register(
    "append_weekly",
    O.build(
        f"SELECT CAST({LAT} AS DOUBLE) AS latitude, CAST({LON} AS DOUBLE) AS longitude, year, week, "
        + ", ".join(rsql(v) for v in V.DAILY_VARS)
        + ", valid_days FROM weekly_all",
        "weekly_all",
    ),
)
def q_append_weekly(spark, d):
    s = _store(spark, "store-weekly")
    s.append_weekly(V.weekly_all(spark, d), LAT, LON)
    return rounded(_kept(s, "weekly_climate").drop(LOADED_AT))


@register(
    "append_sat_nullfill",
    O.build(
        f"SELECT region AS place, year, week, {rsql('ndvi')}, CAST(NULL AS DOUBLE) AS lst_night_c, "
        "CAST(NULL AS INTEGER) AS valid_days FROM sat_weekly",
        "sat_weekly",
    ),
)
def q_append_sat_nullfill(spark, d):
    s = _store(spark, "store-sat")
    s.append_satellite(V.sat_weekly_t(spark, d).select(F.col("region").alias("place"), "year", "week", "ndvi"))
    return rounded(_kept(s, "weekly_satellite").drop(LOADED_AT))


# ------------------------------------------------------------------ A12 latest-load-wins
_T1, _T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _loads(spark, d):
    c = V.cases_t(spark, d).select("region", "year", "week", "cases")
    l1 = c.withColumns({LOADED_AT: F.lit(_T1).cast("timestamp"), "load_no": F.lit(1)})
    l2 = c.filter(F.col("week") % 2 == 0).withColumns(
        {"cases": F.col("cases") + 1, LOADED_AT: F.lit(_T2).cast("timestamp"), "load_no": F.lit(2)}
    )
    return l1.unionByName(l2)


@register(
    "dedup_latest",
    O.build(
        "SELECT region, year, week, cases, load_no FROM ("
        "SELECT *, row_number() OVER (PARTITION BY region, year, week ORDER BY loaded_at DESC) AS rn FROM ("
        f"SELECT region, year, week, cases, TIMESTAMP '{_T1}' AS loaded_at, 1 AS load_no FROM cases UNION ALL "
        f"SELECT region, year, week, cases + 1, TIMESTAMP '{_T2}', 2 FROM cases WHERE week % 2 = 0)) WHERE rn = 1",
        "cases",
    ),
)
def q_dedup_latest(spark, d):
    return dedup_latest(_loads(spark, d), ["region", "year", "week"]).select("region", "year", "week", "cases", "load_no")


# ------------------------------------------------------------------ A13 refresh
@register("refresh_table", O.build(_CASE_SQL.replace("week, cases,", "week, cases + 1 AS cases,"), "cases"))
def q_refresh_table(spark, d):
    s = _store(spark, "store-refresh")
    cases = V.cases_t(spark, d).withColumnRenamed("region", "place")
    s.append_cases(cases)
    s.refresh("cases_raw", cases.withColumn("cases", F.col("cases") + 1))
    return rounded(_kept(s, "cases_raw").select(*_CASE_OUT))


@register("refresh_years", O.build(_CASE_SQL.replace("week, cases,", "week, cases + CASE WHEN year % 3 = 0 THEN 1 ELSE 0 END AS cases,"), "cases"))
def q_refresh_years(spark, d):
    """Every third year is delivered again; the other years' files stay as they are."""
    s = _store(spark, "store-years", partition_by_year=True)
    cases = V.cases_t(spark, d).withColumnRenamed("region", "place")
    s.append_cases(cases)
    s.refresh_years("cases_raw", cases.filter("year % 3 = 0").withColumn("cases", F.col("cases") + 1))
    s.drop()  # a partitioned table is listed by the catalog, its folder by the reader
    return rounded(spark.read.parquet(f"{s.root}/cases_raw").select(*_CASE_OUT))


# ------------------------------------------------------------------ A5 / D1 tables bucketed by entity
BUCKETS = 8
_SAT4 = ("ndvi", "lst_night_c")


@register(
    "lag_join_bucketed",
    O.build(
        f"SELECT c.region AS place, c.se, c.cases, {', '.join(rsql(f'k.{v}_lag4') for v in _SAT4)}, k.valid_days_lag4 FROM cases_idx c "
        f"LEFT JOIN ({O.lagged_sql('sat_weekly_idx', 4, [*_SAT4, 'valid_days'], REGION)}) k ON k.region = c.region AND k.tidx = c.idx",
        "cases_idx",
        "sat_weekly_idx",
    ),
)
def q_lag_join_bucketed(spark, d):
    """The lag join of two tables at rest, bucketed by place: no exchange of either."""
    s = _store(spark, "store-buckets", buckets=BUCKETS)
    s.append_cases(V.cases_t(spark, d).withColumnRenamed("region", "place"))
    s.append_satellite(V.sat_weekly_t(spark, d).withColumnRenamed("region", "place"))
    path = scratch_path(spark, "lag-join-bucketed")
    with co_located(spark):
        joined = lag_join(s.table("cases_raw").drop(LOADED_AT), s.table("weekly_satellite").drop(LOADED_AT), 4, "place")
        joined.select("place", "se", "cases", *[f"{v}_lag4" for v in _SAT4], "valid_days_lag4").write.parquet(path)
    s.drop()
    return rounded(spark.read.parquet(path))


# ------------------------------------------------------------------ A14 / A15 CSV sink + read-back
_MATRIX_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("variable", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("lag", T.IntegerType()),
        T.StructField("r", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
)


def _csv_oracle():
    needed, ex = O.sweep_ctes([(None, "weekly_idx", V.DAILY_VARS)], LAGS, ["pearson", "spearman"], REGION)
    return O.build(f"SELECT region, variable, method, lag, {rsql('r')}, {rsql('p_value')}, n FROM mat", *needed, extra=ex)


@register("csv_roundtrip", _csv_oracle())
def q_csv_roundtrip(spark, d):
    m = C.corr_matrix(V.cases_t(spark, d), V.weekly_t(spark, d), V.DAILY_VARS, LAGS, "incidence", keys=REGION)
    path = scratch_path(spark, "matrix-csv")
    L.write_csv(m.select(*[f.name for f in _MATRIX_SCHEMA.fields]), path)
    return rounded(L.read_csv(spark, path, _MATRIX_SCHEMA))
