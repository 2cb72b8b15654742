"""Registered calendar, scalar, filter, join, window and summary queries and their oracles
(B1-B8, B10, B17, B18, C1, C5, D2-D6, A4, A11, A16, A17, E20, E21, F5, G3, H1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars as SC
from ..operators import lagjoin as LJ
from ..operators import rollup as R
from ..operators.correlation import avg_rank
from ..operators.frames import date_range, describe, outbreak_flag, table_coverage
from ..session import scratch_path
from ..sources.tables import Store
from ..sources.zones import validate_points, zone_lookup
from . import oracle as O
from . import views as V
from .catalog import REGION, dsql, register, rounded, rsql

# ------------------------------------------------------------------ B1 parse YYYYWW
@register(
    "parse_yearweek",
    O.build(
        "SELECT region, se, "
        "CASE WHEN ok THEN CAST(se // 100 AS INTEGER) END AS year_parsed, "
        "CASE WHEN ok THEN CAST(se % 100 AS INTEGER) END AS week_parsed, ok AS valid FROM ("
        "SELECT region, se, (length(CAST(se AS VARCHAR)) = 6 AND se // 100 BETWEEN 2000 AND 2100 "
        "AND se % 100 BETWEEN 1 AND 53) AS ok FROM cases)",
        "cases",
    ),
)
def q_parse_yearweek(spark, d):
    c = V.cases_t(spark, d)
    y, w, ok = cal.parse_yearweek(F.col("se"))
    return c.select("region", "se", y.alias("year_parsed"), w.alias("week_parsed"), ok.alias("valid"))


# ------------------------------------------------------------------ B2 / B4 / B5 calendars
_DAYS = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem"


def _ship_days(spark, d):
    return V.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()


@register(
    "iso_week",
    O.build(
        f"SELECT {dsql('day')}, CAST(isoyear(day) AS INTEGER) AS iso_year, CAST(week(day) AS INTEGER) AS iso_week, "
        + dsql("date_trunc('week', day)", "week_start")
        + " FROM days",
        extra=[("days", _DAYS)],
    ),
)
def q_iso_week(spark, d):
    return rounded(
        _ship_days(spark, d).select(
            "day",
            cal.date_to_year("day").alias("iso_year"),
            cal.date_to_week("day").alias("iso_week"),
            cal.week_start_of("day").alias("week_start"),
        )
    )


@register(
    "cdc_week",
    O.build(
        f"SELECT {dsql('day')}, cdc_year, CAST(date_diff('day', w1, sun) // 7 + 1 AS INTEGER) AS cdc_week, {dsql('sun', 'week_start')} FROM ("
        "SELECT day, sun, CAST(year(sun + 3) AS INTEGER) AS cdc_year, "
        "make_date(year(sun + 3), 1, 4) - CAST(dayofweek(make_date(year(sun + 3), 1, 4)) AS INTEGER) AS w1 FROM ("
        "SELECT day, day - CAST(dayofweek(day) AS INTEGER) AS sun FROM days))",
        extra=[("days", _DAYS)],
    ),
)
def q_cdc_week(spark, d):
    return rounded(
        _ship_days(spark, d).select(
            "day",
            cal.date_to_year("day", "cdc").alias("cdc_year"),
            cal.date_to_week("day", "cdc").alias("cdc_week"),
            cal.week_start_of("day", "cdc").alias("week_start"),
        )
    )


_WEEKS = "SELECT DISTINCT year, week FROM cases"


@register(
    "week_start",
    O.build(f"SELECT year, week, {dsql(O.week_start_sql('year', 'week'), 'week_start')} FROM wk", "cases", extra=[("wk", _WEEKS)]),
)
def q_week_start(spark, d):
    w = V.cases_t(spark, d).select("year", "week").distinct()
    return rounded(w.select("year", "week", cal.week_start("year", "week").alias("week_start")))


_ADD_LAGS = [-53, -8, -1, 1, 4, 8, 53]


@register(
    "week_add",
    O.build(
        "SELECT year, week, lag, CAST(isoyear(t) AS INTEGER) AS year_target, CAST(week(t) AS INTEGER) AS week_target FROM ("
        f"SELECT year, week, CAST(l.lag AS INTEGER) AS lag, {O.week_start_sql('year', 'week')} + 7 * l.lag AS t "
        f"FROM wk, (SELECT unnest([{', '.join(map(str, _ADD_LAGS))}]) AS lag) l)",
        "cases",
        extra=[("wk", _WEEKS)],
    ),
)
def q_week_add(spark, d):
    w = V.cases_t(spark, d).select("year", "week").distinct()
    w = w.withColumn("lag", F.explode(F.array(*[F.lit(x) for x in _ADD_LAGS])))
    return w.select(
        "year",
        "week",
        "lag",
        cal.week_add_year("year", "week", F.col("lag")).alias("year_target"),
        cal.week_add_week("year", "week", F.col("lag")).alias("week_target"),
    )


# ------------------------------------------------------------------ D2 lag targets
@register(
    "lag_targets",
    O.build(
        "SELECT region, year, week, CAST(isoyear(t) AS INTEGER) AS year_target, CAST(week(t) AS INTEGER) AS week_target "
        f"FROM (SELECT region, year, week, {O.week_start_sql('year', 'week')} + 28 AS t FROM weekly)",
        "weekly",
    ),
)
def q_lag_targets(spark, d):
    return LJ.lag_targets(V.weekly_t(spark, d), lag=4).select("region", "year", "week", "year_target", "week_target")


# ------------------------------------------------------------------ B6 / B7 / A4 / D4 / D5
def _ndvi(spark, d):
    return V.sat_band(spark, d, "NDVI").select("region", "day", SC.scale_ndvi("mean_dn").alias("ndvi"))


def _lst(spark, d):
    return V.sat_band(spark, d, "LST").select("region", "day", SC.scale_lst("mean_dn").alias("lst_night_c"))


@register(
    "scale_ndvi",
    O.build(f"SELECT zone AS region, {dsql('image_date', 'day')}, {rsql('mean_dn / 10000.0', alias='ndvi')} FROM sat_zonal WHERE band = 'NDVI'", "sat_zonal"),
)
def q_scale_ndvi(spark, d):
    return rounded(_ndvi(spark, d))


@register(
    "scale_lst",
    O.build(f"SELECT region, {dsql('day')}, {rsql('lst_night_c')} FROM lst_daily", "lst_daily"),
)
def q_scale_lst(spark, d):
    return rounded(_lst(spark, d))


@register(
    "zonal_mean",
    O.build(
        f"SELECT zone, band, {dsql('image_date')}, {rsql('mean_dn')} FROM (SELECT zone, band, image_date, avg(dn) AS mean_dn "
        "FROM event_pixels GROUP BY 1, 2, 3) WHERE mean_dn IS NOT NULL",
        "event_pixels",
    ),
)
def q_zonal_mean(spark, d):
    return rounded(R.zonal_mean(V.event_pixels(spark, d), keys=["zone", "band"]))


_BOX = {"x": "pixel", "y": "dn", "xmin": 20, "xmax": 700, "ymin": 500.0, "ymax": 8000.0}


@register(
    "zonal_mean_box",
    O.build(
        f"SELECT zone, band, {dsql('image_date')}, {rsql('sum(dn * (pixel % 3 + 1)) / sum(pixel % 3 + 1)', alias='mean_dn')} FROM event_pixels "
        "WHERE pixel BETWEEN 20 AND 700 AND dn BETWEEN 500.0 AND 8000.0 GROUP BY zone, band, event_pixels.image_date",
        "event_pixels",
    ),
)
def q_zonal_mean_box(spark, d):
    """Weighted means over the pixels within a footprint."""
    px = V.event_pixels(spark, d).withColumn("w", F.col("pixel") % 3 + 1)
    return rounded(R.zonal_mean(px, keys=["zone", "band"], weight_col="w", bbox=_BOX))


@register("daily_spine_ffill", O.build(f"SELECT region, {dsql('day')}, {rsql('ndvi')} FROM ndvi_daily", "ndvi_daily"))
def q_daily_spine_ffill(spark, d):
    return rounded(R.daily_spine_ffill(_ndvi(spark, d), V.SPINE_START, V.SPINE_END, keys=REGION, date_col="day", value_cols=["ndvi"]))


@register("daily_outer", O.build(f"SELECT region, {dsql('day')}, {rsql('ndvi')}, {rsql('lst_night_c')} FROM sat_daily", "sat_daily"))
def q_daily_outer(spark, d):
    filled = R.daily_spine_ffill(_ndvi(spark, d), V.SPINE_START, V.SPINE_END, keys=REGION, date_col="day", value_cols=["ndvi"])
    return rounded(R.daily_outer(filled, _lst(spark, d), REGION).select("region", "day", "ndvi", "lst_night_c"))


@register(
    "weekly_satellite",
    O.build(
        f"SELECT region, year, week, {rsql('ndvi')}, {rsql('lst_night_c')}, valid_days FROM sat_weekly",
        "sat_weekly",
    ),
)
def q_weekly_satellite(spark, d):
    """Pixel table -> zone means -> scaling -> spine fill -> outer join -> weekly roll-up."""
    return rounded(V.sat_weekly(spark, d).select("region", "year", "week", "ndvi", "lst_night_c", "valid_days"))


# ------------------------------------------------------------------ B8 accents, B10 labels
@register("fold_accents", O.build("SELECT doc_id, strip_accents(text) AS folded FROM documents"))
def q_fold_accents(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", SC.fold_accents("text").alias("folded"))


_LABELS = {"click": "Click", "view": "Page view", "purchase": "Purchase"}


@register(
    "relabel",
    O.build(
        "SELECT coalesce(CASE event_type "
        + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items())
        + " END, event_type) AS label, count(*) AS events FROM events GROUP BY 1"
    ),
)
def q_relabel(spark, d):
    ev = V.table(spark, d, "events")
    return ev.groupBy(SC.relabel("event_type", _LABELS).alias("label")).agg(F.count(F.lit(1)).alias("events"))


# ------------------------------------------------------------------ C4 lookup by folded name
# Requests: every distinct word of the benchmark; zone dimension: every (doc_id, word)
# occurrence in the documents. Each request gets the first occurrence (by doc_id, then word)
# whose folded form equals its folded form, and the number of such occurrences; names
# without any come back with no zone and 0 occurrences.
_WORD_SPLIT = "[^\\p{L}]+"


def _tokens(spark, d, name, key):
    texts = V.table(spark, d, name).select(key, "text")
    return texts.select(key, F.explode(F.split("text", _WORD_SPLIT)).alias("word")).filter(F.col("word") != "")


def _tokens_sql(name, key):
    return f"SELECT {key}, word FROM (SELECT {key}, unnest(regexp_split_to_array(text, '[^\\p{{L}}]+')) AS word FROM {name}) WHERE word <> ''"


@register(
    "zone_lookup",
    O.build(
        "SELECT r.name, z.zone_id, z.zone_name, coalesce(z.n_matches, 0) AS n_matches FROM "
        "(SELECT DISTINCT word AS name FROM asked) r LEFT JOIN "
        "(SELECT k, zone_id, zone_name, n_matches FROM (SELECT strip_accents(word) AS k, doc_id AS zone_id, word AS zone_name, "
        "count(*) OVER (PARTITION BY strip_accents(word)) AS n_matches, "
        "row_number() OVER (PARTITION BY strip_accents(word) ORDER BY doc_id, word) AS rn FROM toks) WHERE rn = 1) z "
        "ON strip_accents(r.name) = z.k",
        extra=[("toks", _tokens_sql("documents", "doc_id")), ("asked", _tokens_sql("benchmark", "item_id"))],
    ),
)
def q_zone_lookup(spark, d):
    # pre-aggregated per distinct word (map-side combine); the occurrence table is
    # represented by (first doc, word, occurrences)
    zones = _tokens(spark, d, "documents", "doc_id").groupBy("word").agg(F.min("doc_id").alias("zone_id"), F.count(F.lit(1)).alias("occurrences"))
    requests = _tokens(spark, d, "benchmark", "item_id").select(F.col("word").alias("name")).distinct()
    matches, missing = zone_lookup(requests, zones.withColumnRenamed("word", "zone_name"), weight_col="occurrences")
    absent = missing.select("name", F.lit(None).cast("long").alias("zone_id"), F.lit(None).cast("string").alias("zone_name"), F.lit(0).cast("long").alias("n_matches"))
    return matches.select("name", "zone_id", "zone_name", "n_matches").unionByName(absent)


# ------------------------------------------------------------------ B17 / B18 / C1 / C5
@register(
    "validate_points",
    O.build(
        "SELECT c_custkey, latitude, longitude, nullif(concat_ws('; ', "
        "CASE WHEN latitude IS NULL OR NOT latitude BETWEEN -90.0 AND 90.0 THEN 'latitude out of range' END, "
        "CASE WHEN longitude IS NULL OR NOT longitude BETWEEN -180.0 AND 180.0 THEN 'longitude out of range' END), '') AS reason, "
        "NOT (coalesce(NOT latitude BETWEEN -90.0 AND 90.0, true) OR coalesce(NOT longitude BETWEEN -180.0 AND 180.0, true)) AS valid "
        "FROM (SELECT c_custkey, c_acctbal / 100.0 AS latitude, CAST(c_custkey % 400 - 200 AS DOUBLE) AS longitude FROM customer)"
    ),
)
def q_validate_points(spark, d):
    c = V.table(spark, d, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 100.0).alias("latitude"),
        (F.col("c_custkey") % 400 - 200).cast("double").alias("longitude"),
    )
    return validate_points(c).select("c_custkey", "latitude", "longitude", "reason", "valid")


OUTBREAK_PER_100K = 3500.0


@register(
    "outbreak_weeks",
    O.build(
        f"SELECT region, year, week, {rsql('incidence')}, level FROM cases WHERE incidence > {OUTBREAK_PER_100K}",
        "cases",
    ),
)
def q_outbreak_weeks(spark, d):
    c = outbreak_flag(V.cases_t(spark, d), "incidence", OUTBREAK_PER_100K)
    return rounded(c.filter("outbreak").select("region", "year", "week", "incidence", "level"))


@register(
    "date_range",
    O.build(
        f"SELECT {dsql('l_shipdate', 'day')}, count(*) AS lines, round(sum(l_extendedprice), 2) + 0.0 AS price_sum "
        "FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' GROUP BY 1"
    ),
)
def q_date_range(spark, d):
    li = date_range(V.table(spark, d, "lineitem"), "l_shipdate", "1996-01-01", "1996-12-31")
    out = li.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_extendedprice").alias("price_sum")
    )
    return rounded(out)


# ------------------------------------------------------------------ E20 / E21 / A16 / A17 / A11
@register(
    "join_coverage",
    O.build(
        "SELECT c.region, count(*) AS case_rows, count(k.qty_mean_lag4) AS rows_with_data, 'qty_mean_lag4' AS ref_column "
        f"FROM cases_idx c LEFT JOIN ({O.lagged_sql('weekly_idx', 4, ['qty_mean'], REGION)}) k "
        "ON k.region = c.region AND k.tidx = c.idx GROUP BY c.region",
        "cases_idx",
        "weekly_idx",
    ),
)
def q_join_coverage(spark, d):
    j = LJ.lag_join(V.cases_t(spark, d), V.weekly_t(spark, d), lag=4, keys=REGION)
    return LJ.join_coverage(j, 4, REGION)


_DESC_VARS = [*V.DAILY_VARS]
_STATS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


@register(
    "describe_weekly",
    O.build(
        "SELECT region, variable, count(x) AS count, "
        + ", ".join(
            f"{O.rnd(e, 4)} AS {n}"
            for n, e in [
                ("mean", "avg(x)"),
                ("std", "stddev_samp(x)"),
                ("min", "min(x)"),
                ("p25", "quantile_cont(x, 0.25)"),
                ("p50", "quantile_cont(x, 0.5)"),
                ("p75", "quantile_cont(x, 0.75)"),
                ("max", "max(x)"),
            ]
        )
        + " FROM ("
        + " UNION ALL ".join(f"SELECT region, '{v}' AS variable, CAST({v} AS DOUBLE) AS x FROM weekly" for v in _DESC_VARS)
        + ") GROUP BY region, variable",
        "weekly",
    ),
)
def q_describe_weekly(spark, d):
    return rounded(describe(V.weekly_t(spark, d), _DESC_VARS, REGION), default=4)


@register(
    "table_coverage",
    O.build(
        "SELECT 'cases' AS table_name, min(year) AS min_year, max(year) AS max_year, count(*) AS rows, "
        "CAST(NULL AS DOUBLE) AS avg_ndvi, CAST(NULL AS DOUBLE) AS avg_lst FROM cases "
        "UNION ALL SELECT 'weekly_climate', min(year), max(year), count(*), NULL, NULL FROM weekly "
        f"UNION ALL SELECT 'weekly_satellite', min(year), max(year), count(*), {O.rnd('avg(ndvi)')}, {O.rnd('avg(lst_night_c)')} FROM sat_weekly",
        "cases",
        "weekly",
        "sat_weekly",
    ),
)
def q_table_coverage(spark, d):
    parts = [
        table_coverage(V.cases_t(spark, d), "cases"),
        table_coverage(V.weekly_t(spark, d), "weekly_climate"),
        table_coverage(V.sat_weekly_t(spark, d), "weekly_satellite", means={"avg_ndvi": "ndvi", "avg_lst": "lst_night_c"}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return rounded(out.select("table_name", "min_year", "max_year", "rows", "avg_ndvi", "avg_lst"))


_CASE_OUT = ["geocode", "region", "se", "year", "week", "cases", "cases_est", "incidence", "level"]


@register(
    "ordered_scan",
    O.build(
        f"SELECT geocode, region, se, year, week, cases, {rsql('cases_est')}, {rsql('incidence')}, level FROM cases "
        "ORDER BY region, year, week",
        "cases",
    ),
)
def q_ordered_scan(spark, d):
    return rounded(V.cases_t(spark, d).select(*_CASE_OUT).orderBy("region", "year", "week"))


_ADHOC = (
    "SELECT region, count(*) AS weeks, CAST(sum(cases) AS BIGINT) AS cases, "
    "round(avg(incidence), 6) + 0.0 AS mean_incidence FROM v_cases GROUP BY region"
)


@register("adhoc_sql", O.build(_ADHOC.replace("FROM v_cases", "FROM cases"), "cases"))
def q_adhoc_sql(spark, d):
    V.cases_t(spark, d).createOrReplaceTempView("v_cases")
    found = Store(spark, scratch_path(spark, "store-adhoc")).load(_ADHOC)
    spark.catalog.dropTempView("v_cases")
    return found


# ------------------------------------------------------------------ F5 / G3 / H1
@register(
    "avg_rank",
    O.build(
        f"SELECT region, year, week, {O.avg_rank_sql('incidence', 'region')} AS rank_incidence FROM cases",
        "cases",
    ),
)
def q_avg_rank(spark, d):
    c = V.cases_t(spark, d)
    return c.select("region", "year", "week", avg_rank("incidence", ["region"]).alias("rank_incidence"))


@register(
    "top_weeks",
    O.build(
        f"SELECT region, year, week, {rsql('ndvi')}, {rsql('lst_night_c')}, valid_days FROM sat_weekly "
        "ORDER BY year, week, region LIMIT 5",
        "sat_weekly",
    ),
)
def q_top_weeks(spark, d):
    s = V.sat_weekly_t(spark, d).select("region", "year", "week", "ndvi", "lst_night_c", "valid_days")
    return rounded(s.orderBy("year", "week", "region").limit(5))


@register(
    "union_sources",
    O.build(
        "SELECT region, year, week, source, "
        + ", ".join(rsql(c) for c in (*V.DAILY_VARS, *V.SAT_VARS))
        + ", valid_days FROM ("
        "SELECT region, year, week, 'climate' AS source, qty_mean, qty_max, qty_min, price_sum, disc_pct, "
        "CAST(NULL AS DOUBLE) AS ndvi, CAST(NULL AS DOUBLE) AS lst_night_c, valid_days FROM weekly UNION ALL "
        "SELECT region, year, week, 'satellite', NULL, NULL, NULL, NULL, NULL, ndvi, lst_night_c, valid_days FROM sat_weekly)",
        "weekly",
        "sat_weekly",
    ),
)
def q_union_sources(spark, d):
    a = V.weekly_t(spark, d).withColumn("source", F.lit("climate"))
    b = V.sat_weekly_t(spark, d).withColumn("source", F.lit("satellite"))
    u = a.unionByName(b, allowMissingColumns=True)
    return rounded(u.select("region", "year", "week", "source", *V.DAILY_VARS, *V.SAT_VARS, "valid_days"))
