"""DuckDB SQL fragments used to build independent oracles for the registered queries.

Each oracle recomputes its answer from the raw tables (region nation customer
supplier orders lineitem events documents), never from a Spark result. Literals
are cast to DOUBLE where DuckDB would otherwise use DECIMAL arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def week_start_sql(y: str, w: str) -> str:
    """ISO Monday of (year, week)."""
    return f"(CAST(date_trunc('week', make_date(CAST({y} AS BIGINT), 1, 4)) AS DATE) + CAST(7 * ({w} - 1) AS INTEGER))"


def idx_sql(y: str, w: str) -> str:
    return f"(date_diff('day', DATE '1970-01-05', {week_start_sql(y, w)}) // 7)"


def pvalue_sql(r: str, n: str) -> str:
    """Two-sided Student-t p-value of r on n pairs via the finite series by parity of n-2."""
    even = (
        f"1.0 - abs({r}) * list_sum(list_transform(range(0, CAST(({n} - 2) // 2 AS BIGINT)), "
        f"lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1.0)) * pow(1.0 - {r} * {r}, j)))"
    )
    odd = (
        f"1.0 - (2.0 / pi()) * (asin(abs({r})) + abs({r}) * sqrt(1.0 - {r} * {r}) * "
        f"coalesce(list_sum(list_transform(range(0, CAST(({n} - 3) // 2 AS BIGINT)), "
        f"lambda j: exp(lgamma(j + 1.0) + lgamma(1.5) - lgamma(j + 1.5)) * pow(1.0 - {r} * {r}, j))), 0.0))"
    )
    return (
        f"CASE WHEN {r} IS NULL OR {n} < 3 THEN NULL WHEN abs({r}) >= 1 THEN 0.0 "
        f"WHEN ({n} - 2) % 2 = 0 THEN greatest(0.0, least(1.0, {even})) "
        f"ELSE greatest(0.0, least(1.0, {odd})) END"
    )


def rnd(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def build(select: str, *needed: str, extra: Sequence[tuple[str, str]] = ()) -> str:
    """Prefix `select` with the WITH clause holding `needed` (plus dependencies),
    followed by query-specific `extra` (name, sql) CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    items = [(n, CTES[n][0]) for n in order] + list(extra)
    if not items:
        return select
    body = ",\n".join(f"{n} AS (\n{q}\n)" for n, q in items)
    return f"WITH {body}\n{select}"


# ---------------------------------------------------------------- base views
cte("reg", "SELECT n.n_nationkey, r.r_regionkey AS geocode, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
cte("cust", "SELECT c.c_custkey, reg.geocode, reg.region FROM customer c JOIN reg ON c.c_nationkey = reg.n_nationkey", "reg")
cte("pop", "SELECT region, count(*) AS customers FROM cust GROUP BY region", "cust")
cte(
    "cases",
    """SELECT CAST(w.geocode AS INTEGER) AS geocode, w.region, CAST(w.year * 100 + w.week AS INTEGER) AS se,
       w.year, w.week, w.cases, w.cases_est,
       CAST(w.cases AS DOUBLE) * 100000.0 / p.customers AS incidence,
       CAST(CASE WHEN w.cases >= 15 THEN 4 WHEN w.cases >= 10 THEN 3 WHEN w.cases >= 5 THEN 2 ELSE 1 END AS INTEGER) AS level
FROM (SELECT cust.geocode, cust.region,
             CAST(isoyear(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS year,
             CAST(week(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS week,
             count(*) AS cases, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 6))) AS DOUBLE) / 1000.0 AS cases_est
      FROM orders o JOIN cust ON o.o_custkey = cust.c_custkey GROUP BY 1, 2, 3, 4) w
JOIN pop p ON p.region = w.region""",
    "cust",
    "pop",
)
cte(
    "cases_all",
    """SELECT CAST(isoyear(CAST(o_orderdate AS DATE)) AS INTEGER) AS year, CAST(week(CAST(o_orderdate AS DATE)) AS INTEGER) AS week,
       count(*) AS cases, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 6))) AS DOUBLE) / 1000.0 AS cases_est,
       CAST(count(*) AS DOUBLE) * 100000.0 / (SELECT count(*) FROM customer) AS incidence
FROM orders GROUP BY 1, 2""",
)
cte("sreg", "SELECT s.s_suppkey, reg.region FROM supplier s JOIN reg ON s.s_nationkey = reg.n_nationkey", "reg")
DAILY_VARS = ("qty_mean", "qty_max", "qty_min", "price_sum", "disc_pct")
SAT_VARS = ("ndvi", "lst_night_c")
# daily values as decimals, so that weekly sums and means are exact in any order
DAILY_AGGS = """CAST(avg(l.l_quantity) AS DECIMAL(20, 9)) AS qty_mean, CAST(max(l.l_quantity) AS DECIMAL(20, 9)) AS qty_max,
       CAST(min(l.l_quantity) AS DECIMAL(20, 9)) AS qty_min, sum(CAST(l.l_extendedprice AS DECIMAL(18, 6))) AS price_sum,
       CAST(CAST(sum(CAST(l.l_discount AS DECIMAL(18, 6))) AS DOUBLE) / count(l.l_discount) * 100.0::DOUBLE AS DECIMAL(20, 9)) AS disc_pct"""


def exact_mean(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {c}"


cte(
    "daily_exact",
    f"""SELECT sreg.region, CAST(l.l_shipdate AS DATE) AS day, {DAILY_AGGS}
FROM lineitem l JOIN sreg ON l.l_suppkey = sreg.s_suppkey GROUP BY 1, 2""",
    "sreg",
)
cte("daily_all_exact", f"SELECT CAST(l.l_shipdate AS DATE) AS day, {DAILY_AGGS} FROM lineitem l GROUP BY 1")
AS_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DAILY_VARS)
cte("daily", f"SELECT region, day, {AS_DOUBLES} FROM daily_exact", "daily_exact")
cte("daily_all", f"SELECT day, {AS_DOUBLES} FROM daily_all_exact", "daily_all_exact")
WEEKLY_AGGS = f"""{exact_mean('qty_mean')}, {exact_mean('qty_max')}, {exact_mean('qty_min')},
       coalesce(CAST(sum(price_sum) AS DOUBLE), 0.0) AS price_sum, {exact_mean('disc_pct')}, CAST(count(day) AS INTEGER) AS valid_days"""
cte(
    "weekly",
    f"SELECT region, CAST(isoyear(day) AS INTEGER) AS year, CAST(week(day) AS INTEGER) AS week, {WEEKLY_AGGS} FROM daily_exact GROUP BY 1, 2, 3",
    "daily_exact",
)
cte(
    "weekly_all",
    f"SELECT CAST(isoyear(day) AS INTEGER) AS year, CAST(week(day) AS INTEGER) AS week, {WEEKLY_AGGS} FROM daily_all_exact GROUP BY 1, 2",
    "daily_all_exact",
)
# satellite path: line items as pixels of their supplier's region
cte(
    "sat_pixels",
    """SELECT sreg.region AS zone, CAST(l.l_shipdate AS DATE) AS image_date, l.l_quantity, l.l_discount, l.l_tax
FROM lineitem l JOIN sreg ON l.l_suppkey = sreg.s_suppkey""",
    "sreg",
)
cte(
    "sat_zonal",
    """SELECT zone, 'LST' AS band, image_date, avg(CASE WHEN l_discount <> 0 THEN 14000.0 + l_quantity * 40.0 END) AS mean_dn
FROM sat_pixels GROUP BY 1, 2, 3 HAVING mean_dn IS NOT NULL
UNION ALL
SELECT zone, 'NDVI' AS band, image_date, avg(round(l_tax * 100000.0)) AS mean_dn
FROM sat_pixels WHERE date_diff('day', DATE '1995-01-01', image_date) % 16 = 0 GROUP BY 1, 2, 3""",
    "sat_pixels",
)
cte(
    "ndvi_daily",
    """SELECT s.region, s.day,
       last_value(c.ndvi IGNORE NULLS) OVER (PARTITION BY s.region ORDER BY s.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ndvi
FROM (SELECT z.region, CAST(g.d AS DATE) AS day
      FROM (SELECT DISTINCT zone AS region FROM sat_zonal WHERE band = 'NDVI'
            AND image_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31') z,
           generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(d)) s
LEFT JOIN (SELECT zone AS region, image_date AS day, mean_dn / 10000.0 AS ndvi FROM sat_zonal WHERE band = 'NDVI') c
  ON c.region = s.region AND c.day = s.day""",
    "sat_zonal",
)
cte(
    "lst_daily",
    "SELECT zone AS region, image_date AS day, mean_dn * 0.02 - 273.15 AS lst_night_c FROM sat_zonal WHERE band = 'LST'",
    "sat_zonal",
)
cte(
    "sat_daily",
    """SELECT coalesce(a.region, b.region) AS region, coalesce(a.day, b.day) AS day, a.ndvi, b.lst_night_c
FROM ndvi_daily a FULL OUTER JOIN lst_daily b ON a.region = b.region AND a.day = b.day""",
    "ndvi_daily",
    "lst_daily",
)
cte(
    "sat_weekly",
    f"""SELECT region, CAST(isoyear(day) AS INTEGER) AS year, CAST(week(day) AS INTEGER) AS week,
       {exact_mean('ndvi')}, {exact_mean('lst_night_c')}, CAST(count(day) AS INTEGER) AS valid_days
FROM (SELECT region, day, CAST(ndvi AS DECIMAL(20, 9)) AS ndvi, CAST(lst_night_c AS DECIMAL(20, 9)) AS lst_night_c FROM sat_daily) GROUP BY 1, 2, 3""",
    "sat_daily",
)
cte("cases_idx", f"SELECT *, {idx_sql('year', 'week')} AS idx FROM cases", "cases")
cte("cases_all_idx", f"SELECT *, {idx_sql('year', 'week')} AS idx FROM cases_all", "cases_all")
cte("weekly_idx", f"SELECT *, {idx_sql('year', 'week')} AS idx FROM weekly", "weekly")
cte("weekly_all_idx", f"SELECT *, {idx_sql('year', 'week')} AS idx FROM weekly_all", "weekly_all")
cte("sat_weekly_idx", f"SELECT *, {idx_sql('year', 'week')} AS idx FROM sat_weekly", "sat_weekly")
cte(
    "event_pixels",
    """SELECT CAST(ts AS DATE) AS image_date, user_id AS pixel, CAST(user_id % 5 AS INTEGER) AS zone, event_type AS band,
       CASE WHEN value <= 90.0 THEN value * 100.0 END AS dn FROM events""",
)

def lagged_sql(src_idx: str, lag: int, cols: Sequence[str], keys: Sequence[str]) -> str:
    """Climate rows re-keyed to the case week they explain, columns suffixed _lag{N}."""
    k = "".join(f"{c}, " for c in keys)
    vals = ", ".join(f"{c} AS {c}_lag{lag}" for c in cols)
    return f"SELECT {k}idx + {lag} AS tidx, {vals} FROM {src_idx}"


def avg_rank_sql(x: str, part: str) -> str:
    return (
        f"(CAST(rank() OVER (PARTITION BY {part} ORDER BY {x}) AS DOUBLE) + "
        f"(count(*) OVER (PARTITION BY {part}, {x}) - 1) / 2.0)"
    )


def pair_stats_sql(long_cte: str, group: Sequence[str], min_n: int = 3) -> str:
    """Grouped Pearson + Spearman (r, n) from a long CTE with columns group..., x, y.

    Returns a SELECT producing group..., n, r_pearson, r_spearman (every group of
    the long table present, n = 0 when no pair survives).
    """
    g = ", ".join(group)
    on = " AND ".join(f"g.{c} IS NOT DISTINCT FROM st.{c}" for c in group)
    gsel = ", ".join(f"g.{c}" for c in group)
    return f"""SELECT {gsel}, coalesce(st.n, 0) AS n,
  CASE WHEN st.n >= {min_n} AND st.minx < st.maxx AND st.miny < st.maxy THEN greatest(-1.0, least(1.0, st.cxy / (st.sx * st.sy))) END AS r_pearson,
  CASE WHEN st.n >= {min_n} AND st.minx < st.maxx AND st.miny < st.maxy THEN greatest(-1.0, least(1.0, st.crr / (st.srx * st.sry))) END AS r_spearman
FROM (SELECT DISTINCT {g} FROM {long_cte}) g
LEFT JOIN (
  SELECT {g}, count(*) AS n, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy,
         covar_pop(x, y) AS cxy, stddev_pop(x) AS sx, stddev_pop(y) AS sy,
         covar_pop(rx, ry) AS crr, stddev_pop(rx) AS srx, stddev_pop(ry) AS sry
  FROM (SELECT {g}, x, y,
          {avg_rank_sql('x', g)} AS rx,
          {avg_rank_sql('y', g)} AS ry
        FROM {long_cte} WHERE x IS NOT NULL AND y IS NOT NULL) p
  GROUP BY {g}) st ON {on}"""


def methods_sql(stats_cte: str, cols: Sequence[str], methods: Sequence[str] = ("pearson", "spearman"), rounded: bool = True) -> str:
    """Long (method) rows with r and p from a pair_stats_sql CTE (rounded unless asked not to)."""
    c = ", ".join(cols)
    parts = []
    for m in methods:
        r, p = f"r_{m}", pvalue_sql(f"r_{m}", "n")
        if rounded:
            r, p = rnd(r), rnd(p, 9)
        parts.append(f"SELECT {c}, '{m}' AS method, {r} AS r, {p} AS p_value, n FROM {stats_cte}")
    return "\nUNION ALL\n".join(parts)


def sweep_ctes(sources, lags, methods, keys, target="incidence", cases_idx="cases_idx"):
    """(needed base CTEs, extra CTEs) whose last CTE `mat` holds the unrounded sweep:
    keys, [source], variable, method, lag, r, p_value, n."""
    with_source = any(s is not None for s, _, _ in sources)
    group = [*keys, *(["source"] if with_source else []), "variable", "lag"]
    needed = [cases_idx, *dict.fromkeys(c for _, c, _ in sources)]
    extra = [
        ("long", sweep_long_sql(sources, lags, target, keys, cases_idx)),
        ("st", pair_stats_sql("long", group)),
        ("mat", methods_sql("st", group, methods, rounded=False)),
    ]
    return needed, extra


def sweep_long_sql(sources, lags: Sequence[int], target: str, keys: Sequence[str], cases_idx: str = "cases_idx") -> str:
    """Long (keys, [source], variable, lag, x, y) rows of the lag sweep.

    sources: list of (source_name_or_None, src_idx_cte, variables).
    """
    k = list(keys)
    kc = "".join(f"c.{c}, " for c in k)
    on = "".join(f"w.{c} = cx.{c} AND " for c in k)
    lag_list = ", ".join(str(int(l)) for l in lags)
    cx = (
        f"SELECT {kc}CAST(l.lag AS INTEGER) AS lag, c.idx - l.lag AS src, CAST(c.{target} AS DOUBLE) AS y "
        f"FROM {cases_idx} c, (SELECT unnest([{lag_list}]) AS lag) l"
    )
    parts = []
    for src, idx_cte, variables in sources:
        scol = f"'{src}' AS source, " if src is not None else ""
        kk = "".join(f"cx.{c}, " for c in k)
        for v in variables:
            parts.append(
                f"SELECT {kk}{scol}'{v}' AS variable, cx.lag, CAST(w.{v} AS DOUBLE) AS x, cx.y "
                f"FROM ({cx}) cx LEFT JOIN {idx_cte} w ON {on}w.idx = cx.src"
            )
    return "\nUNION ALL\n".join(parts)
