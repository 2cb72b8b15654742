"""How the supplied TPC-H-style tables play the roles of the analytical data model.

| view            | role                      | built from                                          |
| --------------- | ------------------------- | --------------------------------------------------- |
| cases           | weekly outcome per place  | orders x customer x nation x region, by ISO week     |
| cases_all       | single-series outcome     | same without the region                              |
| daily           | daily drivers per place   | lineitem x supplier x nation x region, by ship day   |
| daily_all       | single-series drivers     | lineitem by ship day                                 |
| weekly          | weekly drivers            | ``weekly_rollup(daily)``                             |
| sat_pixels      | pixel table (two bands)   | lineitem rows as pixels of their supplier's region   |
| sat_weekly      | weekly satellite table    | zonal mean -> scale -> spine fill -> outer -> weekly |
| event_pixels    | pixel table (30 days)     | events                                               |

``*_t`` variants (cases_t, weekly_t, sat_weekly_t, ...) are the same weekly tables
materialized once per session (``stored``): the roll-up keys compute from raw tables,
the analysis keys read these tables at rest.

Every view is lazy and reads whole tables; dimension tables (nation, region)
are left to the planner, which broadcasts them from their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.scalars import scale_lst, scale_ndvi
from ..operators.rollup import daily_spine_ffill, weekly_rollup, zonal_mean
from ..session import app_key, scratch_path

# Fixed parameters of the test mapping.
SPINE_START, SPINE_END = "1995-01-01", "2001-12-31"
COMPOSITE_EVERY_DAYS = 16
DAILY_VARS = ("qty_mean", "qty_max", "qty_min", "price_sum", "disc_pct")
SAT_VARS = ("ndvi", "lst_night_c")


_READERS: dict[tuple[str, str], tuple[object, DataFrame]] = {}
_VIEWS: dict[tuple[str, str, str], tuple[object, DataFrame]] = {}


def listing(spark: SparkSession, path: str) -> object:
    """Names, sizes and times of what ``path`` holds (or of the file it is). Plans and tables
    at rest are kept under it, so that a changed source is read anew."""
    try:
        sc = spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        found = at.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(at)
        return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))
    except Exception:  # noqa: BLE001 - e.g. a Connect session: nothing is kept
        return object()


def memo(fn):
    """Views are pure, lazy functions of (session, folder): build each plan once while the
    folder's listing stays the same."""

    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, state = (app_key(spark), sf_dir.rstrip("/"), fn.__name__), listing(spark, sf_dir)
        if key not in _VIEWS or _VIEWS[key][0] != state:
            _VIEWS[key] = state, fn(spark, sf_dir)
        return _VIEWS[key][1]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet reader, kept per application and path while the listing stays the same
    (the DataFrame itself holds no data)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key, state = (app_key(spark), path), listing(spark, path)
    if key not in _READERS or _READERS[key][0] != state:
        _READERS[key] = state, spark.read.parquet(path)
    return _READERS[key][1]


@memo
def nation_region(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_regionkey").alias("geocode"), F.col("r_name").alias("region")
    )


@memo
def customer_region(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = nation_region(spark, sf_dir)
    return c.join(nr, c.c_nationkey == nr.n_nationkey).select("c_custkey", "geocode", "region")


def _level(cases_col):
    return (
        F.when(cases_col >= 15, 4).when(cases_col >= 10, 3).when(cases_col >= 5, 2).otherwise(1).cast("int")
    )


@memo
def cases(spark, sf_dir) -> DataFrame:
    """Weekly outcome per region: cases, cases_est, incidence per 100k customers, se, level."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    cr = customer_region(spark, sf_dir)
    pop = cr.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))
    weekly = (
        o.join(cr, o.o_custkey == cr.c_custkey)
        .groupBy(
            "geocode",
            "region",
            cal.date_to_year("day").alias("year"),
            cal.date_to_week("day").alias("week"),
        )
        .agg(F.count(F.lit(1)).alias("cases"), (F.sum(F.col("o_totalprice").cast(MONEY)).cast("double") / 1000.0).alias("cases_est"))
    )
    return weekly.join(pop, "region").select(
        F.col("geocode").cast("int").alias("geocode"),
        "region",
        (F.col("year") * 100 + F.col("week")).cast("int").alias("se"),
        "year",
        "week",
        "cases",
        "cases_est",
        (F.col("cases").cast("double") * 100000.0 / F.col("customers")).alias("incidence"),
        _level(F.col("cases")).alias("level"),
    )


@memo
def cases_all(spark, sf_dir) -> DataFrame:
    """Single-series outcome (no entity), as the original runs it."""
    o = table(spark, sf_dir, "orders").select("o_totalprice", F.to_date("o_orderdate").alias("day"))
    # population total as a scalar subquery (one aggregated value, no join)
    customers = table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    weekly = o.groupBy(cal.date_to_year("day").alias("year"), cal.date_to_week("day").alias("week")).agg(
        F.count(F.lit(1)).alias("cases"), (F.sum(F.col("o_totalprice").cast(MONEY)).cast("double") / 1000.0).alias("cases_est")
    )
    return weekly.select(
        "year",
        "week",
        "cases",
        "cases_est",
        (F.col("cases").cast("double") * 100000.0 / customers).alias("incidence"),
    )


# Daily values are decimals: sums and means over a week are then exact, whatever the order
# of its days, and equal weeks rank as equal.
EXACT, MONEY = "decimal(20,9)", "decimal(18,6)"


def _daily_aggs():
    return [
        F.avg("l_quantity").cast(EXACT).alias("qty_mean"),
        F.max("l_quantity").cast(EXACT).alias("qty_max"),
        F.min("l_quantity").cast(EXACT).alias("qty_min"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("price_sum"),
        (F.sum(F.col("l_discount").cast(MONEY)).cast("double") / F.count("l_discount") * 100.0).cast(EXACT).alias("disc_pct"),
    ]


def _doubles(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@memo
def supplier_region(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nr = nation_region(spark, sf_dir)
    return s.join(nr, s.s_nationkey == nr.n_nationkey).select("s_suppkey", "region")


@memo
def daily(spark, sf_dir) -> DataFrame:
    """Daily drivers per (supplier) region."""
    return _doubles(daily_exact(spark, sf_dir), DAILY_VARS)


@memo
def daily_exact(spark, sf_dir) -> DataFrame:
    """Daily drivers per (supplier) region, as decimals."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", F.to_date("l_shipdate").alias("day")
    )
    sr = supplier_region(spark, sf_dir)
    return li.join(sr, li.l_suppkey == sr.s_suppkey).groupBy("region", "day").agg(*_daily_aggs())


@memo
def daily_all(spark, sf_dir) -> DataFrame:
    return _doubles(daily_all_exact(spark, sf_dir), DAILY_VARS)


@memo
def daily_all_exact(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("day")).agg(*_daily_aggs())


@memo
def weekly(spark, sf_dir) -> DataFrame:
    return weekly_rollup(daily_exact(spark, sf_dir), keys=["region"])


@memo
def weekly_all(spark, sf_dir) -> DataFrame:
    return weekly_rollup(daily_all_exact(spark, sf_dir))


@memo
def sat_pixels(spark, sf_dir) -> DataFrame:
    """Every line item is a surface-temperature pixel of its supplier's region on its
    ship day (cloud = NULL where the discount is 0); on every 16th day it is also a
    vegetation pixel (DN = tax * 1e5)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_discount", "l_tax", F.to_date("l_shipdate").alias("image_date")
    )
    sr = supplier_region(spark, sf_dir)
    px = li.join(sr, li.l_suppkey == sr.s_suppkey)
    composite = (F.datediff("image_date", F.lit(SPINE_START).cast("date")) % COMPOSITE_EVERY_DAYS) == 0
    lst = F.struct(
        F.lit("LST").alias("band"),
        F.when(F.col("l_discount") != 0.0, 14000.0 + F.col("l_quantity") * 40.0).alias("dn"),
    )
    ndvi = F.struct(F.lit("NDVI").alias("band"), F.round(F.col("l_tax") * 100000.0).alias("dn"))
    bands = F.when(composite, F.array(lst, ndvi)).otherwise(F.array(lst))
    return px.select(F.col("region").alias("zone"), "image_date", F.inline(bands))


def sat_band(spark, sf_dir, band: str) -> DataFrame:
    """Zone means of one band; days without it are left out before the join and the sums."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount", "l_tax", F.to_date("l_shipdate").alias("image_date"))
    if band == "NDVI":
        li = li.filter((F.datediff("image_date", F.lit(SPINE_START).cast("date")) % COMPOSITE_EVERY_DAYS) == 0)
        dn = F.round(F.col("l_tax") * 100000.0)
    else:
        dn = F.when(F.col("l_discount") != 0.0, 14000.0 + F.col("l_quantity") * 40.0)
    sr = supplier_region(spark, sf_dir)
    px = li.join(sr, li.l_suppkey == sr.s_suppkey).select(F.col("region"), F.col("image_date").alias("day"), dn.alias("dn"))
    return zonal_mean(px, keys=["region"], date_col="day")


@memo
def sat_daily(spark, sf_dir) -> DataFrame:
    """Zone means -> one row per (zone, day) with a column per band -> vegetation
    spine-filled over the calendar, surface temperature carried on its own days.

    One pixel aggregation feeds one spine join (zones come from the region
    dimension), so the pixel table is scanned once.
    """
    zm = zonal_mean(sat_pixels(spark, sf_dir), keys=["zone", "band"])
    wide = zm.groupBy("zone", "image_date").pivot("band", ["NDVI", "LST"]).agg(F.first("mean_dn"))
    return _filled_days(spark, sf_dir, wide.select(F.col("zone").alias("region"), F.col("image_date").alias("day"), "NDVI", "LST"))


def _filled_days(spark, sf_dir, means: DataFrame) -> DataFrame:
    """Band means per (region, day), columns NDVI and LST -> daily satellite values."""
    obs = means.select("region", "day", scale_ndvi("NDVI").alias("ndvi"), scale_lst("LST").alias("lst_night_c"))
    zones = nation_region(spark, sf_dir).select("region").distinct()
    # the spine's full outer join is the daily outer join of the two bands (D4); rows
    # outside the calendar survive only when they carry a temperature
    return daily_spine_ffill(
        obs, SPINE_START, SPINE_END, keys=["region"], date_col="day", value_cols=["ndvi"],
        zones=zones, carry_cols=["lst_night_c"], keep_outside=True,
    ).filter(F.col("ndvi").isNotNull() | F.col("lst_night_c").isNotNull() | F.col("day").between(SPINE_START, SPINE_END))


@memo
def sat_weekly(spark, sf_dir) -> DataFrame:
    return _sat_weeks(sat_daily(spark, sf_dir))


def _sat_weeks(days: DataFrame) -> DataFrame:
    return weekly_rollup(days.withColumns({c: F.col(c).cast(EXACT) for c in SAT_VARS}), keys=["region"])


def region_days(spark, sf_dir) -> DataFrame:
    """Daily drivers and both bands' means per (region, day), in one pass over the line
    items: what the weekly tables at rest are rolled up from."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.to_date("l_shipdate").alias("day")
    )
    sr = supplier_region(spark, sf_dir)
    composite = (F.datediff("day", F.lit(SPINE_START).cast("date")) % COMPOSITE_EVERY_DAYS) == 0
    ndvi = F.avg(F.when(composite, F.round(F.col("l_tax") * 100000.0)))
    lst = F.avg(F.when(F.col("l_discount") != 0.0, 14000.0 + F.col("l_quantity") * 40.0))
    return li.join(sr, li.l_suppkey == sr.s_suppkey).groupBy("region", "day").agg(*_daily_aggs(), ndvi.alias("NDVI"), lst.alias("LST"))


@memo
def event_pixels(spark, sf_dir) -> DataFrame:
    """events as pixels: zone = user_id % 5, band = event_type, DN = value*100 (NULL above 90)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.to_date("ts").alias("image_date"),
        F.col("user_id").alias("pixel"),
        (F.col("user_id") % 5).cast("int").alias("zone"),
        F.col("event_type").alias("band"),
        F.when(F.col("value") <= 90.0, F.col("value") * 100.0).alias("dn"),
    )


# ------------------------------------------------------------------ tables at rest
_STORED: dict[tuple[str, str, str], tuple[object, DataFrame]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The weekly table `name` as a table at rest: computed from the whole raw tables
    on first use in the session, and again after the source folder changed, written as
    parquet below the shared checkpoint folder, then read back by every analysis. This is
    the original's design (collect once into tables, analyse many times) and at scale it is
    what keeps each analysis from re-aggregating the raw daily/pixel data; it also cuts the
    lineage, so a lost executor re-reads the table instead of recomputing the roll-ups.
    """
    base, state = (app_key(spark), sf_dir.rstrip("/")), listing(spark, sf_dir)

    def fresh(n):
        return (*base, n) in _STORED and _STORED[*base, n][0] == state

    if not fresh(name):
        group = next((g for g in COLLECTED_TOGETHER if name in g), (name,))
        _materialize(spark, sf_dir, [n for n in group if not fresh(n)], state)
    return _STORED[*base, name][1]


# tables the original collects in one run; the first request materializes the whole
# group with concurrent jobs (independent scans share the executors)
COLLECTED_TOGETHER = (("cases", "weekly", "sat_weekly"), ("cases_all", "weekly_all"))


def _materialize(spark: SparkSession, sf_dir: str, names, state) -> None:
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    def keep(name: str, df: DataFrame) -> str:
        path = scratch_path(spark, f"table-{name}")
        df.write.mode("overwrite").parquet(path)
        return path

    def of_days(made: list[str]) -> list[tuple[str, str]]:
        days = spark.read.parquet(keep("region_days", region_days(spark, sf_dir)))
        weeks = {
            "weekly": lambda: weekly_rollup(days.select("region", "day", *DAILY_VARS), keys=["region"]),
            "sat_weekly": lambda: _sat_weeks(_filled_days(spark, sf_dir, days.filter(F.col("NDVI").isNotNull() | F.col("LST").isNotNull()))),
        }
        return [(n, keep(n, weeks[n]())) for n in made]

    def one(task) -> list[tuple[str, str]]:
        return of_days(task) if isinstance(task, list) else [(task, keep(task, globals()[task](spark, sf_dir)))]

    rolled = [n for n in names if n in ("weekly", "sat_weekly")]
    tasks = [n for n in names if n not in rolled] + [rolled] * bool(rolled)

    if len(tasks) > 1:
        with ThreadPool(len(tasks)) as pool:
            done = pool.map(inheritable_thread_target(spark)(one), tasks)
    else:
        done = [one(t) for t in tasks]
    for name, path in (made for part in done for made in part):
        _STORED[app_key(spark), sf_dir.rstrip("/"), name] = state, spark.read.parquet(path)


def cases_t(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "cases")


def cases_all_t(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "cases_all")


def weekly_t(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "weekly")


def weekly_all_t(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "weekly_all")


def sat_weekly_t(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "sat_weekly")
