"""Tables at rest (A5-A13): parquet tables with fixed schemas, appends with
required-column checks, load-time stamps, latest-load-wins de-duplication,
full refresh and ad-hoc SQL.

Tables live under a root folder (on a cluster: a shared path, e.g. below
``spark.checkpoint.dir`` for scratch use) and are registered in the session
catalog with ``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION``.
Inserted row counts come from ``observe()`` on the write itself, not a second scan.

Tables may be partitioned by year (``partition_by_year``): a range of years reads only its
folders, and ``refresh_years`` replaces only the years it is given. They may be bucketed by
their entity (``buckets``): joins and windows whose keys hold the entity, on tables with as many
buckets, then run without an exchange (see ``co_located``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import YEAR_BOUNDS, parse_yearweek
from ..functions.scalars import normalize_nans

LOADED_AT = "loaded_at"

CLIMATE_VARS = ("qty_mean", "qty_max", "qty_min", "price_sum", "disc_pct")


def table_schemas(climate_vars: Sequence[str] = CLIMATE_VARS) -> dict[str, T.StructType]:
    """Schemas of the four tables; the climate tables hold the named variables."""
    return {
        "cases_raw": T.StructType(
            [
                T.StructField("geocode", T.IntegerType(), False),
                T.StructField("place", T.StringType(), False),
                T.StructField("se", T.IntegerType(), False),
                T.StructField("year", T.IntegerType(), False),
                T.StructField("week", T.IntegerType(), False),
                T.StructField("cases", T.LongType()),
                T.StructField("cases_est", T.DoubleType()),
                T.StructField("level", T.IntegerType()),
                T.StructField("incidence", T.DoubleType()),
                T.StructField(LOADED_AT, T.TimestampType()),
            ]
        ),
        "daily_climate": T.StructType(
            [
                T.StructField("latitude", T.DoubleType(), False),
                T.StructField("longitude", T.DoubleType(), False),
                T.StructField("day", T.DateType(), False),
                *[T.StructField(v, T.DoubleType()) for v in climate_vars],
                T.StructField(LOADED_AT, T.TimestampType()),
            ]
        ),
        "weekly_climate": T.StructType(
            [
                T.StructField("latitude", T.DoubleType(), False),
                T.StructField("longitude", T.DoubleType(), False),
                T.StructField("year", T.IntegerType(), False),
                T.StructField("week", T.IntegerType(), False),
                *[T.StructField(v, T.DoubleType()) for v in climate_vars],
                T.StructField("valid_days", T.IntegerType()),
                T.StructField(LOADED_AT, T.TimestampType()),
            ]
        ),
        "weekly_satellite": T.StructType(
            [
                T.StructField("place", T.StringType(), False),
                T.StructField("year", T.IntegerType(), False),
                T.StructField("week", T.IntegerType(), False),
                T.StructField("ndvi", T.DoubleType()),
                T.StructField("lst_night_c", T.DoubleType()),
                T.StructField("valid_days", T.IntegerType()),
                T.StructField(LOADED_AT, T.TimestampType()),
            ]
        ),
    }


#: what a table's rows are bucketed by: the outcome and satellite series by place, climate by point
ENTITY = {"cases_raw": ("place",), "daily_climate": ("latitude", "longitude"), "weekly_climate": ("latitude", "longitude"), "weekly_satellite": ("place",)}

CASE_REQUIRED = ("geocode", "place", "se", "cases", "cases_est", "level", "incidence")


def _require(df: DataFrame, cols: Sequence[str]) -> None:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


MARK = "[lagframe] "


def _fail(message: str, kind: T.DataType):
    """An expression that fails the write with ``message``."""
    return F.raise_error(F.lit(f"{MARK}{message}{MARK}")).cast(kind)


def _ddl(schema: T.StructType) -> str:
    """Columns of a table; rows that SQL inserts without a load time get the current one (A10)."""
    stamp = {LOADED_AT: " DEFAULT current_timestamp()"}
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{stamp.get(f.name, '')}" for f in schema.fields)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def co_located(spark: SparkSession):
    """Within it, plans join bucketed tables on their entity and more (the week) in place: rows
    of one entity already lie together, which is enough for any keys that hold the entity.
    Plans are fixed when they run, so the action belongs inside."""
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


class Store:
    """A set of parquet tables under `root`, registered in the session catalog. The climate
    tables hold the variables named in `climate_vars`. Tables with a year column are
    partitioned by it if `partition_by_year`, and all are bucketed by their entity into
    `buckets` files per write (and year), if given."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        year_bounds: tuple[int, int] = YEAR_BOUNDS,
        climate_vars: Sequence[str] = CLIMATE_VARS,
        partition_by_year: bool = False,
        buckets: int = 0,
    ):
        self.schemas = table_schemas(climate_vars)
        self.by_year = partition_by_year
        self.buckets = buckets
        self.year_bounds = year_bounds
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def drop(self) -> None:
        """Take the tables out of the session catalog; their files stay."""
        for t in self.schemas:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(t)}")

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def create_schema(self) -> None:
        """Create every table if it does not exist (idempotent) (A5)."""
        for t, s in self.schemas.items():
            layout = " PARTITIONED BY (year)" if self._by_year(t) else ""
            if self.buckets:
                layout += f" CLUSTERED BY ({', '.join(ENTITY[t])}) INTO {self.buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(t)} ({_ddl(s)}) USING parquet{layout} LOCATION '{self.root}/{t}'")

    def _by_year(self, t: str) -> bool:
        return self.by_year and "year" in self.schemas[t].fieldNames()

    def table(self, t: str) -> DataFrame:
        return self.spark.table(self.name(t))

    def _insert(self, t: str, df: DataFrame, mode: str = "append") -> int:
        schema = self.schemas[t]
        stamped = df.withColumn(LOADED_AT, F.current_timestamp())
        nonnull = [f.name for f in schema.fields if not f.nullable]
        _require(stamped, nonnull)
        # NOT NULL is not enforced by parquet tables: the write itself fails on a NULL, so the
        # input is evaluated once; a failed write commits nothing
        cols = []
        for f in schema.fields:
            c = (F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType)
            if not f.nullable:
                c = F.when(c.isNull(), _fail(f"NULL in NOT NULL column {f.name} of {t}", f.dataType)).otherwise(c)
            cols.append(c.alias(f.name))
        obs = Observation(f"insert_{t}")
        out = stamped.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows"))
        if self._by_year(t):  # the catalog puts the partition column last
            out = out.select(*[f.name for f in schema.fields if f.name != "year"], "year")
        if self.buckets:  # one file per bucket (and year) and write
            out = out.repartition(self.buckets, *ENTITY[t])
        try:  # a table's insert takes this from the session alone
            with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic" if mode == "years" else "static"):
                out.write.insertInto(self.name(t), overwrite=(mode != "append"))
        except Exception as e:
            if found := re.search(f"{re.escape(MARK)}(.*?){re.escape(MARK)}", str(e)):
                raise ValueError(found[1]) from e
            raise
        return int(obs.get["rows"])

    def append_cases(self, df: DataFrame) -> int:
        """Append weekly case rows; parses se into (year, week); returns rows inserted."""
        return self._insert("cases_raw", self._cases(df))

    def _cases(self, df: DataFrame) -> DataFrame:
        _require(df, CASE_REQUIRED)
        y, w, ok = parse_yearweek(F.col("se"), self.year_bounds)
        year = F.when(ok, y).otherwise(_fail("invalid se (YYYYWW) values in case rows", T.IntegerType()))
        return normalize_nans(df).withColumns({"year": year, "week": w, "se": F.col("se").cast("int")})

    def append_daily(self, df: DataFrame, latitude: float, longitude: float) -> int:
        """Append daily climate for one point."""
        _require(df, ["day"])
        return self._insert("daily_climate", df.withColumns({"latitude": F.lit(float(latitude)), "longitude": F.lit(float(longitude))}))

    def append_weekly(self, df: DataFrame, latitude: float, longitude: float) -> int:
        """Append weekly climate for one point."""
        _require(df, ["year", "week"])
        return self._insert("weekly_climate", df.withColumns({"latitude": F.lit(float(latitude)), "longitude": F.lit(float(longitude))}))

    def append_satellite(self, df: DataFrame, place: str | None = None) -> int:
        """Append weekly satellite rows; absent optional columns become NULL.

        With `place` given it overwrites the place column; otherwise the frame's own
        `place` column is used (many places in one append).
        """
        _require(df, ["year", "week"])
        d = df
        for c, t in (("ndvi", "double"), ("lst_night_c", "double"), ("valid_days", "int")):
            if c not in d.columns:
                d = d.withColumn(c, F.lit(None).cast(t))
        if place is not None:
            d = d.withColumn("place", F.lit(place))
        _require(d, ["place"])
        return self._insert("weekly_satellite", d)

    def refresh(self, t: str, df: DataFrame) -> int:
        """Full refresh: replace the table's rows (A13). Parquet tables have no DELETE."""
        return self._insert(t, df, mode="overwrite")

    def refresh_years(self, t: str, df: DataFrame) -> int:
        """Replace the rows of the years that ``df`` holds, all of each such year, and leave the
        files of the other years alone (A13). Needs a table partitioned by year; returns the
        rows inserted. Case rows take their year from ``se``, as in ``append_cases``."""
        if not self._by_year(t):
            raise ValueError(f"{t} is not partitioned by year; use refresh")
        if t == "cases_raw":
            df = self._cases(df)
        return self._insert(t, df, mode="years")

    def load(self, sql: str) -> DataFrame:
        """Ad-hoc SQL over the registered tables and views."""
        return self.spark.sql(sql)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_col: str = LOADED_AT, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the latest-loaded row per business key.

    Implemented as a ``max_by`` aggregate rather than a row_number window: partial
    aggregation collapses copies map-side, so a key holding a third of all rows
    never lands whole in one task. Ties on `order_col` go to the largest `tiebreak`, then
    to the row with the larger hash, so the result does not depend on the order of rows.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(F.col(order_col), *[F.col(c) for c in tiebreak], F.xxhash64(*others))
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), ordering).alias("_latest"))
    return agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in others])
