"""DuckDB oracle text: the bound view as a CTE plus reusable fragments.

Each oracle is ``PREFIX`` + a body. Bodies either continue the CTE list
(start with ``,``) or are a plain ``SELECT``.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..sources.fixtures import zone_obs_sql

ZONE = zone_obs_sql("lineitem")

GRID_LON = "CAST(trunc(lon / 5e-5) AS BIGINT)"
GRID_LAT = "CAST(trunc(lat / 5e-5) AS BIGINT)"
GRID_ID = f"({GRID_LON} * 100000 + {GRID_LAT})"
COUNT_BIN = ("CASE WHEN total_count > 0 AND total_count <= 1 THEN 0 WHEN total_count > 1 AND total_count <= 3 THEN 1 "
             "WHEN total_count > 3 AND total_count <= 10 THEN 2 WHEN total_count > 10 AND total_count <= 30 THEN 3 "
             "WHEN total_count > 30 THEN 4 END")
TIME_PERIOD = ("CASE WHEN hour < 7 THEN 0 WHEN hour < 9 THEN 1 WHEN hour < 12 THEN 2 WHEN hour < 14 THEN 3 "
               "WHEN hour < 17 THEN 4 ELSE 5 END")


def fold_sql(k: int, key: str = "row_id", seed: int = 0) -> str:
    kk = f"({key} + {seed})" if seed else key
    return (f"CAST(CAST(floor(((({kk} % 2147483648) * 2654435761) % 4294967296) / 65536) AS BIGINT) % {k} AS INTEGER)")


def mix_sql(key: str = "row_id", seed: int = 0) -> str:
    kk = f"({key} + {seed})" if seed else key
    h = f"((({kk} % 2147483648) * 2654435761) % 4294967296)"
    swapped = f"(({h} % 65536) * 65536 + CAST(floor({h} / 65536) AS BIGINT))"
    return f"(((({swapped} + {seed * 40503}) % 2147483648) * 2246822519) % 4294967296)"


KEYS = (f"{GRID_LON} AS grid_lon, {GRID_LAT} AS grid_lat, {GRID_ID} AS grid_id, "
        f"CAST({COUNT_BIN} AS INTEGER) AS count_bin, CAST({TIME_PERIOD} AS INTEGER) AS time_period, "
        f"{GRID_ID} * 10 + CAST({TIME_PERIOD} AS BIGINT) AS grid_period")


def keyed_cte(k: int = 5) -> str:
    """``kz``: all observations with keys and a k-fold column; ``ktr``/``kte`` splits."""
    return (f", kz AS (SELECT *, {KEYS}, {fold_sql(k)} AS fold FROM zone_obs)"
            ", ktr AS (SELECT * FROM kz WHERE split = 'train')"
            ", kte AS (SELECT * FROM kz WHERE split = 'test')")


PREFIX = f"WITH zone_obs AS ({ZONE})"


def oracle(body: str) -> str:
    body = body.strip()
    if body.startswith(","):
        return f"{PREFIX}\n{body}"
    return f"{PREFIX}\n{body}"


def rank_cte(name: str, src: str, col: str, by: Sequence[str] = (), out: str = "r") -> str:
    """Average-rank table ``name(by..., col, out)`` over distinct values."""
    b = list(by)
    bl = "".join(f"{x}, " for x in b)
    part = f"PARTITION BY {', '.join(b)} " if b else ""
    return (f"{name} AS (SELECT {bl}{col}, sum(n) OVER ({part}ORDER BY {col} ROWS UNBOUNDED PRECEDING) - n "
            f"+ (n + 1) / 2e0 AS {out} FROM (SELECT {bl}{col}, count(*) n FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY {bl}{col}) t_{name})")


def corr_sql(a: str, b: str) -> str:
    """Guarded correlation: NULL when either side is constant (Spark side: same)."""
    return f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0 THEN corr({a}, {b}) END"


def spearman_sql(src: str, a: str, b: str, by: Sequence[str] = (), tag: str = "s") -> tuple[str, str]:
    """(CTE text, select expression) for Spearman of ``a`` and ``b`` over ``src``.

    Produces CTEs ``{tag}_d`` (pairwise complete rows), ``{tag}_ra``, ``{tag}_rb``
    and ``{tag}_j`` (rows with both ranks).
    """
    bl = "".join(f"{x}, " for x in by)
    on = " AND ".join([f"d.{x} = ra.{x}" for x in by] + [f"d.{a} = ra.{a}"])
    on2 = " AND ".join([f"d.{x} = rb.{x}" for x in by] + [f"d.{b} = rb.{b}"])
    dsel = ", ".join([f"d.{x}" for x in by] + ["ra.r AS ra", "rb.r AS rb"])
    ctes = (f", {tag}_d AS (SELECT {bl}{a}, {b} FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            f", {rank_cte(tag + '_ra', tag + '_d', a, by)}"
            f", {rank_cte(tag + '_rb', tag + '_d', b, by)}"
            f", {tag}_j AS (SELECT {dsel} FROM {tag}_d d JOIN {tag}_ra ra ON {on} JOIN {tag}_rb rb ON {on2})")
    return ctes, corr_sql("ra", "rb")


def kfold_cte(name: str, src: str, key: str, k_smooth: float, y: str = "invalid_ratio",
              fold: str = "fold", mu: str | None = None, absent: str = "mean") -> str:
    """Encoding table ``name(key, fold, te)``: statistics of all other folds; ``absent='null'``: none for a key of one fold."""
    lone = "NULL" if absent == "null" else None
    mu = mu or f"(SELECT avg({y}) FROM {src})"
    return (f", {name}_c AS (SELECT {key}, {fold}, sum({y}) s, count({y}) n FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}, {fold})"
            f", {name}_t AS (SELECT {key}, sum(s) s, sum(n) n FROM {name}_c GROUP BY {key})"
            f", {name} AS (SELECT c.{key}, c.{fold}, CAST(CAST(CASE WHEN t.n - c.n > 0 THEN (t.s - c.s + {k_smooth} * {mu}) "
            f"/ (t.n - c.n + {k_smooth}) ELSE {lone or mu} END AS FLOAT) AS DOUBLE) AS te FROM {name}_c c JOIN {name}_t t ON c.{key} = t.{key})")


def full_enc_cte(name: str, src: str, key: str, k_smooth: float, y: str = "invalid_ratio",
                 mu: str | None = None) -> str:
    mu = mu or f"(SELECT avg({y}) FROM {src})"
    return (f", {name} AS (SELECT {key}, CAST(CAST((sum({y}) + {k_smooth} * {mu}) / (count({y}) + {k_smooth}) AS FLOAT) AS DOUBLE) AS te, "
            f"count({y}) AS n FROM {src} WHERE {key} IS NOT NULL GROUP BY {key})")


def f32(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def quantile_sql(col: str, q: float) -> str:
    return f"quantile_cont({col}, {q!r})"


def ks_sql(tag: str, src: str, x: str = "x", s: str = "s", first: str = "train", second: str = "test") -> str:
    """CTEs ending in ``{tag}(ks, na, nb)``: two-sample KS of ``x`` split by ``s``."""
    return (f", {tag}_v AS (SELECT {x} AS x, sum(CASE WHEN {s} = '{first}' THEN 1 ELSE 0 END) a, "
            f"sum(CASE WHEN {s} = '{second}' THEN 1 ELSE 0 END) b FROM {src} WHERE {x} IS NOT NULL GROUP BY {x})"
            f", {tag}_n AS (SELECT sum(a) na, sum(b) nb FROM {tag}_v)"
            f", {tag}_c AS (SELECT x, sum(a) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) ca, "
            f"sum(b) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) cb FROM {tag}_v)"
            f", {tag} AS (SELECT max(abs(CAST(ca AS DOUBLE) / na - CAST(cb AS DOUBLE) / nb)) AS ks, "
            f"min(na) AS na, min(nb) AS nb FROM {tag}_c CROSS JOIN {tag}_n)")


def kfold_extra(k: int, name: str) -> str:
    return f", kz_{name} AS (SELECT *, {fold_sql(k)} AS {name} FROM kz)"
