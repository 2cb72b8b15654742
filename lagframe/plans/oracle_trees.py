"""DuckDB SQL of single regression trees, level by level (oracles of the forest keys)."""

from __future__ import annotations

from ..operators.weekly_forest import EPSILON

MIN_LEAF = 5


def best_split_sql(rows: str, group: str) -> str:
    """Per group the best split of ``rows`` (group, xs list of feature values, y whole number)."""
    return f"""SELECT {group}, f, cut, score - whole AS drop FROM (
  SELECT *, (v + nv) / 2e0 AS cut, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, f, v) AS k FROM (
    SELECT *, ls::DOUBLE * ls::DOUBLE / lc::DOUBLE + (t - ls)::DOUBLE * (t - ls)::DOUBLE / (n - lc)::DOUBLE AS score, t::DOUBLE * t::DOUBLE / n::DOUBLE AS whole FROM (
      SELECT {group}, f, v, sum(c) OVER up AS lc, sum(s) OVER up AS ls, lead(v) OVER up AS nv, sum(c) OVER every AS n, sum(s) OVER every AS t FROM (
        SELECT {group}, f, v, count(*) AS c, sum(y) AS s FROM (SELECT {group}, y, unnest(range(1, len(xs) + 1)) AS f, unnest(xs) AS v FROM {rows}) GROUP BY ALL)
      WINDOW up AS (PARTITION BY {group}, f ORDER BY v), every AS (PARTITION BY {group}, f))
    WHERE nv IS NOT NULL AND lc >= {MIN_LEAF} AND n - lc >= {MIN_LEAF})
  WHERE score > whole + {EPSILON}::DOUBLE * (1e0 + abs(whole))) WHERE k = 1"""


def walk_forward_ctes(name: str, features: list[str], depth: int, source: str = "bf") -> list[tuple[str, str]]:
    """CTEs up to ``name`` (region, row_no, pred): the tree of all earlier rows, for each test row."""
    xs = f"[{', '.join(f'{c}::DOUBLE' for c in features)}]"
    y = "CAST(round(incidence * 1000000e0) AS BIGINT)"
    ctes = [(f"{name}_all", f"SELECT region, row_no, {xs} AS xs, {y} AS y FROM {source}")]
    ctes.append((f"{name}_0", f"SELECT t.region, t.row_no, t.xs AS tx, r.xs, r.y FROM {name}_all t JOIN {name}_all r ON r.region = t.region AND r.row_no < t.row_no WHERE t.row_no > 52"))
    for level in range(depth):
        ctes.append((f"{name}_s{level}", best_split_sql(f"{name}_{level}", "region, row_no")))
        ctes.append((f"{name}_{level + 1}", f"SELECT r.region, r.row_no, tx, xs, y FROM {name}_{level} r JOIN {name}_s{level} s ON s.region = r.region AND s.row_no = r.row_no WHERE (xs[f] > cut) = (tx[f] > cut)"))
    means = " UNION ALL ".join(f"SELECT region, row_no, {level} AS level, sum(y)::DOUBLE / count(*)::DOUBLE AS m FROM {name}_{level} GROUP BY ALL" for level in range(depth + 1))
    ctes.append((name, f"SELECT region, row_no, greatest(0e0, max_by(m, level) / 1000000e0) AS pred FROM ({means}) GROUP BY ALL"))
    return ctes


def importance_ctes(name: str, features: list[str], depth: int, source: str = "model") -> list[tuple[str, str]]:
    """CTEs up to ``name`` (region, f, importance) of one tree on all rows of a region."""
    xs = f"[{', '.join(f'{c}::DOUBLE' for c in features)}]"
    ctes = [(f"{name}_0", f"SELECT region, 1 AS node, {xs} AS xs, CAST(round(incidence * 1000000e0) AS BIGINT) AS y FROM {source}")]
    for level in range(depth):
        ctes.append((f"{name}_s{level}", best_split_sql(f"{name}_{level}", "region, node")))
        ctes.append((f"{name}_{level + 1}", f"SELECT r.region, 2 * r.node + (xs[f] > cut)::INT AS node, xs, y FROM {name}_{level} r JOIN {name}_s{level} s ON s.region = r.region AND s.node = r.node"))
    drops = " UNION ALL ".join(f"SELECT region, f, drop FROM {name}_s{level}" for level in range(depth))
    every = f"SELECT region, unnest(range(1, {len(features) + 1})) AS f, 0e0 AS drop FROM (SELECT DISTINCT region FROM {name}_0)"
    ctes.append((name, f"SELECT region, f, sum(drop) / nullif(sum(sum(drop)) OVER (PARTITION BY region), 0e0) AS importance FROM ({drops} UNION ALL {every}) GROUP BY region, f"))
    return ctes
