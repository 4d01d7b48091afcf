"""Registered profile and aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import profile as P
from ..operators import ranks, stats, transform
from ..sources.fixtures import RAW_FEATURES, zone_obs
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6, r6f

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_DESC_COLS = RAW_FEATURES + [_Y]


def _melt_sql(src: str, cols) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


@query("e1_describe", sql=f"""
, m AS ({_melt_sql("zone_obs WHERE split = 'train'", _DESC_COLS)})
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
 round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM m WHERE value IS NOT NULL GROUP BY feature""")
def e1_describe(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    d = P.describe(tr, _DESC_COLS)
    return d.select("feature", "count", *[r6(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


_INFO_COLS = ["row_id", "total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month", _Y]
_INFO_TYPES = {"row_id": "BIGINT", "total_count": "INTEGER", "hour": "INTEGER", "dow": "INTEGER", "month": "INTEGER"}


@query("e2_info", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{_INFO_TYPES.get(c, 'DOUBLE')}' AS dtype, count({c}) AS non_null FROM zone_obs"
    for c in _INFO_COLS) + ") t")
def e2_info(spark, sf):
    return P.info(zone_obs(spark, sf).select(*_INFO_COLS))


@query("e3_null_profile", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"round(100e0 * (count(*) - count({c})) / count(*), 6) AS null_pct FROM zone_obs" for c in _INFO_COLS)
    + ") t WHERE nulls > 0")
def e3_null_profile(spark, sf):
    n = P.null_profile(zone_obs(spark, sf).select(*_INFO_COLS))
    return n.select("column", "nulls", r6("null_pct"))


@query("e4_group_stats", sql=K + """
SELECT count_bin, count(invalid_ratio) AS count, round(avg(invalid_ratio), 6) AS mean, round(stddev_samp(invalid_ratio), 6) AS std,
 round(quantile_cont(invalid_ratio, 0.5), 6) AS median FROM ktr GROUP BY count_bin""")
def e4_group_stats(spark, sf):
    tr, _ = keyed_split(spark, sf)
    g = P.group_stats(tr, ["count_bin"], _Y)
    return g.select("count_bin", "count", r6("mean"), r6("std"), r6("median"))


_TP_SQL = """
, tp AS (SELECT 'hour' AS dim, CAST(hour AS BIGINT) AS key, invalid_ratio FROM zone_obs WHERE split = 'train'
 UNION ALL SELECT 'dow', CAST(dow AS BIGINT), invalid_ratio FROM zone_obs WHERE split = 'train'
 UNION ALL SELECT 'month', CAST(month AS BIGINT), invalid_ratio FROM zone_obs WHERE split = 'train')
, tpg AS (SELECT dim, key, count(invalid_ratio) AS n, avg(invalid_ratio) AS mean,
 stddev_samp(invalid_ratio) / sqrt(count(invalid_ratio)) AS sem FROM tp GROUP BY dim, key)
"""


@query("e5_temporal_profile", sql=_TP_SQL + """
SELECT dim, key, n, round(mean, 6) AS mean, round(sem, 6) AS sem, round(mean - 2e0 * sem, 6) AS lo,
 round(mean + 2e0 * sem, 6) AS hi FROM tpg""")
def e5_temporal_profile(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    t = P.temporal_profile(tr, ["hour", "dow", "month"], _Y)
    return t.select("dim", "key", "n", r6("mean"), r6("sem"), r6("lo"), r6("hi"))


@query("e6_extreme_groups", sql=_TP_SQL + """
, mx AS (SELECT dim, key, mean, row_number() OVER (PARTITION BY dim ORDER BY mean DESC, key) AS r1,
 row_number() OVER (PARTITION BY dim ORDER BY mean, key) AS r2 FROM tpg)
SELECT a.dim, a.key AS max_key, round(a.mean, 6) AS max_value, b.key AS min_key, round(b.mean, 6) AS min_value
FROM mx a JOIN mx b ON a.dim = b.dim AND a.r1 = 1 AND b.r2 = 1""")
def e6_extreme_groups(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    e = P.extreme_groups(P.temporal_profile(tr, ["hour", "dow", "month"], _Y))
    return e.select("dim", "max_key", r6("max_value"), "min_key", r6("min_value"))


@query("e7_value_counts", sql="SELECT hour, count(*) AS count FROM zone_obs GROUP BY hour ORDER BY hour")
def e7_value_counts(spark, sf):
    return P.value_counts(zone_obs(spark, sf), "hour").orderBy("hour")


@query("e8_n_unique", sql=K + """
SELECT count(DISTINCT grid_id) AS n_unique, round(count(*) / count(DISTINCT grid_id), 6) AS rows_per_key FROM ktr""")
def e8_n_unique(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return P.n_unique(tr, "grid_id").select("n_unique", r6("rows_per_key"))


@query("e9_share", sql="""
SELECT round(avg(CASE WHEN invalid_ratio = 0 THEN 1e0 ELSE 0e0 END), 6) AS zero, round(avg(CASE WHEN invalid_ratio = 1 THEN 1e0 ELSE 0e0 END), 6) AS one,
 round(avg(CASE WHEN total_count = 1 THEN 1e0 ELSE 0e0 END), 6) AS tc1 FROM zone_obs WHERE split = 'train'""")
def e9_share(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    s = P.share(tr, {"zero": F.col(_Y) == 0, "one": F.col(_Y) == 1, "tc1": F.col("total_count") == 1})
    return s.select(r6("zero"), r6("one"), r6("tc1"))


@query("e10_cell_stats", sql=K + """
SELECT grid_id, round(avg(total_count), 6) AS grid_avg_count, round(coalesce(stddev_samp(invalid_ratio), 0e0), 6) AS grid_violation_std,
 CAST(count(invalid_ratio) AS DOUBLE) AS grid_sample_count FROM ktr GROUP BY grid_id""")
def e10_cell_stats(spark, sf):
    tr, _ = keyed_split(spark, sf)
    c = transform.cell_stats(tr)
    return c.select("grid_id", r6("grid_avg_count"), r6("grid_violation_std"), "grid_sample_count")


@query("e11_global_stats", sql=K + """
SELECT round(avg(total_count), 6) AS global_avg_count, round(stddev_samp(invalid_ratio), 6) AS global_violation_std,
 (SELECT round(quantile_cont(c, 0.5), 6) FROM (SELECT count(invalid_ratio) AS c FROM ktr GROUP BY grid_id) q) AS global_sample_count FROM ktr""")
def e11_global_stats(spark, sf):
    tr, _ = keyed_split(spark, sf)
    g = transform.global_stats(tr)
    return spark.range(1).select(r6(g["grid_avg_count"], "global_avg_count"),
                                 r6(g["grid_violation_std"], "global_violation_std"),
                                 r6(g["grid_sample_count"], "global_sample_count"))


_QS = [0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999]


@query("e12_quantile", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({q!r} AS DOUBLE) AS q, round(quantile_cont({c}, {q!r}), 6) AS value FROM zone_obs"
    for c in ["lon", "lat", "wind", "pred_a"] for q in _QS) + ") t")
def e12_quantile(spark, sf):
    m = P.melt(zone_obs(spark, sf), ["lon", "lat", "wind", "pred_a"])
    q = ranks.exact_quantiles(m, "value", _QS, by=["feature"])
    return q.select("feature", "q", r6("value"))


def hist_sql(tag: str, src: str, col: str, bins: int, by: str | None = None, bounds_src: str | None = None) -> str:
    """Oracle text for an equal-width histogram with edge corrections (CTE ``{tag}``)."""
    bsrc = bounds_src or src
    bsel = f"{by}, " if by else ""
    return f"""
, {tag}_b AS (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 5e-1 ELSE min({col}) END AS lo,
  CASE WHEN min({col}) = max({col}) THEN max({col}) + 5e-1 ELSE max({col}) END AS hi FROM {bsrc} WHERE {col} IS NOT NULL)
, {tag}_0 AS (SELECT {bsel}{col} AS x, lo, hi, (hi - lo) / {bins}e0 AS step,
  CAST(trunc(((CAST({col} AS DOUBLE) - lo) / (hi - lo)) * {bins}e0) AS BIGINT) AS i0 FROM {src}, {tag}_b WHERE {col} IS NOT NULL)
, {tag}_1 AS (SELECT *, CASE WHEN i0 = {bins} THEN {bins - 1} ELSE i0 END AS ia FROM {tag}_0)
, {tag}_2 AS (SELECT *, CASE WHEN x < (CASE WHEN ia = {bins} THEN hi ELSE CAST(ia AS DOUBLE) * step + lo END) THEN ia - 1 ELSE ia END AS ib FROM {tag}_1)
, {tag}_3 AS (SELECT *, CASE WHEN x >= (CASE WHEN ib + 1 = {bins} THEN hi ELSE CAST(ib + 1 AS DOUBLE) * step + lo END)
  AND ib <> {bins - 1} THEN ib + 1 ELSE ib END AS bin FROM {tag}_2)
, {tag} AS (SELECT {bsel}bin, count(*) AS count, CAST(bin AS DOUBLE) * min(step) + min(lo) AS "left",
  CASE WHEN bin + 1 = {bins} THEN min(hi) ELSE CAST(bin + 1 AS DOUBLE) * min(step) + min(lo) END AS "right" FROM {tag}_3 GROUP BY {bsel}bin)
"""


@query("e13_histogram", sql=hist_sql("h", "(SELECT * FROM zone_obs WHERE split = 'train')", "pred_b", 50) + """
SELECT bin, count, round("left", 6) AS "left", round("right", 6) AS "right" FROM h""")
def e13_histogram(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    h = P.histogram(tr, "pred_b", 50)
    return h.select("bin", "count", r6("left"), r6("right"))


@query("e14_density_histogram", sql=hist_sql("ha", "zone_obs", "pred_a", 50) + hist_sql("hb", "zone_obs", "pred_b", 50)
       + hist_sql("hy", "zone_obs", "invalid_ratio", 50) + """
SELECT * FROM (SELECT 'pred_a' AS source, bin, count, round(count / ((SELECT count(pred_a) FROM zone_obs) * ("right" - "left")), 6) AS density FROM ha
 UNION ALL SELECT 'pred_b', bin, count, round(count / ((SELECT count(pred_b) FROM zone_obs) * ("right" - "left")), 6) FROM hb
 UNION ALL SELECT 'invalid_ratio', bin, count, round(count / ((SELECT count(invalid_ratio) FROM zone_obs) * ("right" - "left")), 6) FROM hy) t""")
def e14_density_histogram(spark, sf):
    d = P.density_histogram(zone_obs(spark, sf), ["pred_a", "pred_b", _Y], 50)
    return d.select("source", "bin", "count", r6("density"))


@query("e15_histogram_by", sql=K + hist_sql("h", "(SELECT *, CASE WHEN total_count = 1 THEN 'tc1' ELSE 'tc_gt1' END AS grp FROM ktr)",
                                             "pred_b", 50, by="grp", bounds_src="ktr") + """
SELECT grp, bin, count FROM h""")
def e15_histogram_by(spark, sf):
    tr, _ = keyed_split(spark, sf)
    g = tr.withColumn("grp", F.when(F.col("total_count") == 1, "tc1").otherwise("tc_gt1"))
    return P.histogram(g, "pred_b", 50, by=["grp"]).select("grp", "bin", "count")


@query("e16_box_stats", sql=K + """
, q AS (SELECT count_bin, quantile_cont(invalid_ratio, 0.25) AS q1, quantile_cont(invalid_ratio, 0.5) AS med,
  quantile_cont(invalid_ratio, 0.75) AS q3 FROM ktr GROUP BY count_bin)
, w AS (SELECT q.count_bin, q1, med, q3, count(*) AS n,
  coalesce(min(CASE WHEN invalid_ratio >= q1 - 1.5e0 * (q3 - q1) THEN invalid_ratio END), q1) AS whislo,
  coalesce(max(CASE WHEN invalid_ratio <= q3 + 1.5e0 * (q3 - q1) THEN invalid_ratio END), q3) AS whishi
  FROM ktr JOIN q ON ktr.count_bin = q.count_bin GROUP BY q.count_bin, q1, med, q3)
SELECT w.count_bin, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, n, round(whislo, 6) AS whislo, round(whishi, 6) AS whishi,
 CAST(sum(CASE WHEN k.invalid_ratio < whislo OR k.invalid_ratio > whishi THEN 1 ELSE 0 END) AS BIGINT) AS n_fliers
FROM w JOIN ktr k ON k.count_bin = w.count_bin GROUP BY w.count_bin, q1, med, q3, n, whislo, whishi""")
def e16_box_stats(spark, sf):
    tr, _ = keyed_split(spark, sf)
    b = P.box_stats(tr, _Y, ["count_bin"])
    return b.select("count_bin", r6("q1"), r6("median"), r6("q3"), "n", r6("whislo"), r6("whishi"), "n_fliers")


@query("e17_first_per_key", sql=K + "SELECT grid_id, min(grid_lon) AS grid_lon, min(grid_lat) AS grid_lat FROM ktr GROUP BY grid_id")
def e17_first_per_key(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return tr.groupBy("grid_id").agg(F.min("grid_lon").alias("grid_lon"), F.min("grid_lat").alias("grid_lat"))


@query("e18_rate_by", sql="""
SELECT month, CAST(sum(CASE WHEN total_count = 1 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0)) THEN 1 ELSE 0 END) AS BIGINT) AS num,
 CAST(sum(CASE WHEN total_count = 1 THEN 1 ELSE 0 END) AS BIGINT) AS den,
 round(sum(CASE WHEN total_count = 1 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0)) THEN 1 ELSE 0 END)
 / greatest(sum(CASE WHEN total_count = 1 THEN 1 ELSE 0 END), 1), 6) AS rate FROM zone_obs WHERE split = 'train' GROUP BY month""")
def e18_rate_by(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    r = P.rate_by(tr, ["month"], transform.noise_candidates("pred_a", _Y), F.col("total_count") == 1)
    return r.select("month", "num", "den", r6("rate"))


@query("e19_score_by_month", sql="""
SELECT month, round(avg(pred_a), 6) AS mean_score, count(*) AS n FROM zone_obs WHERE split = 'train' GROUP BY month""")
def e19_score_by_month(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return tr.groupBy("month").agg(r6(F.avg("pred_a"), "mean_score"), F.count(F.lit(1)).alias("n"))


_TS = [0.01, 0.02, 0.05, 0.1, 0.15, 0.2]


@query("e20_tail_yield", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT CAST({t!r} AS DOUBLE) AS threshold, CAST(sum(CASE WHEN p < {t!r} OR p > 1 - {t!r} THEN 1 ELSE 0 END) AS BIGINT) AS n_rows, "
    f"round(100e0 * sum(CASE WHEN p < {t!r} OR p > 1 - {t!r} THEN 1 ELSE 0 END) / count(*), 6) AS pct "
    f"FROM (SELECT least(greatest(pred_b, 0e0), 1e0) AS p FROM zone_obs WHERE split = 'test') a" for t in _TS) + ") t")
def e20_tail_yield(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'").withColumn("p", fx.clip01("pred_b"))
    return P.tail_yield(te, "p", _TS).select("threshold", "n_rows", r6("pct"))


@query("e21_calibration", sql="""
, d AS (SELECT pred_a AS p, invalid_ratio AS y FROM zone_obs WHERE split = 'train')
, e AS (SELECT DISTINCT v FROM (""" + " UNION ALL ".join(
    f"SELECT quantile_cont(p, {i / 10!r}) AS v FROM d" for i in range(11)) + """) q)
, b AS (SELECT d.p, d.y, greatest((SELECT count(*) FROM e WHERE e.v < d.p) - 1, 0) AS bin FROM d)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS pred_mean, round(avg(y), 6) AS actual_mean FROM b GROUP BY bin""")
def e21_calibration(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    c = P.calibration(tr, "pred_a", _Y, 10)
    return c.select("bin", "n", r6("pred_mean"), r6("actual_mean"))


@query("e22_segment_counts", sql="""
SELECT count(*) AS n, CAST(sum(CASE WHEN total_count = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tc1,
 CAST(sum(CASE WHEN total_count = 1 AND invalid_ratio = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tc1_y0,
 CAST(sum(CASE WHEN total_count = 1 AND invalid_ratio = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tc1_y1,
 CAST(sum(CASE WHEN total_count = 1 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0)) THEN 1 ELSE 0 END) AS BIGINT) AS noise,
 round(100e0 * sum(CASE WHEN total_count = 1 THEN 1 ELSE 0 END) / count(*), 6) AS tc1_pct FROM zone_obs WHERE split = 'train'""")
def e22_segment_counts(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    tc1 = F.col("total_count") == 1

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return tr.agg(F.count(F.lit(1)).alias("n"), cnt(tc1).alias("tc1"), cnt(tc1 & (F.col(_Y) == 0)).alias("tc1_y0"),
                  cnt(tc1 & (F.col(_Y) == 1)).alias("tc1_y1"),
                  cnt(transform.noise_candidates("pred_a", _Y)).alias("noise"),
                  r6(cnt(tc1) * F.lit(100.0) / F.count(F.lit(1)), "tc1_pct"))


_FS_CTES, _FS_RHO = S.spearman_sql("ktr", "pred_b", "invalid_ratio", ["fold"], "s")


@query("e23_fold_summary", sql=K + _FS_CTES + f"""
, f AS (SELECT fold, {_FS_RHO} AS rho FROM s_j GROUP BY fold)
SELECT round(avg(rho), 6) AS mean_rho, round(stddev_pop(rho), 6) AS std_rho, count(*) AS n_folds FROM f""")
def e23_fold_summary(spark, sf):
    tr, _ = keyed_split(spark, sf)
    f = stats.spearman(tr, "pred_b", _Y, by=["fold"])
    return f.agg(r6(F.avg("rho"), "mean_rho"), r6(F.stddev_pop("rho"), "std_rho"), F.count(F.lit(1)).alias("n_folds"))


@query("e24_summary", sql="""
SELECT round(avg(pred_b), 6) AS mean, round(stddev_samp(pred_b), 6) AS std, round(min(pred_b), 6) AS min,
 round(max(pred_b), 6) AS max, round(quantile_cont(pred_b, 0.5), 6) AS median FROM zone_obs WHERE split = 'train'""")
def e24_summary(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    s = P.summary(tr, "pred_b")
    return s.select(r6("mean"), r6("std"), r6("min"), r6("max"), r6("median"))


@query("e25_indicator_effect", sql="""
, d AS (SELECT CAST(precip > 0 AS INTEGER) AS ind, invalid_ratio FROM zone_obs WHERE split = 'train')
SELECT round(avg(CASE WHEN ind = 1 THEN invalid_ratio END), 6) AS mean_on, round(avg(CASE WHEN ind <> 1 THEN invalid_ratio END), 6) AS mean_off,
 round(avg(CASE WHEN ind = 1 THEN invalid_ratio END) - avg(CASE WHEN ind <> 1 THEN invalid_ratio END), 6) AS diff FROM d""")
def e25_indicator_effect(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'").withColumn("is_raining", fx.indicator("precip"))
    e = P.indicator_effect(tr, "is_raining", _Y)
    return e.select(r6("mean_on"), r6("mean_off"), r6("diff"))


@query("e26_period_profile", sql=K + """
SELECT time_period, count(*) AS n, round(avg(invalid_ratio), 6) AS mean_ratio FROM ktr GROUP BY time_period""")
def e26_period_profile(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return tr.groupBy("time_period").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(_Y), "mean_ratio"))
