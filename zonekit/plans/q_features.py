"""Registered projection, fill, predicate and scalar-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode, transform
from ..operators.hexbin import hex_bin
from ..sources import io
from ..sources.fixtures import zone_obs
from . import pipeline
from . import sqltext as S
from .common import keyed, keyed_split
from .registry import query, r6, r6f

_Y = "invalid_ratio"
K = S.keyed_cte(5)

# ---- B: projections, fills, predicates --------------------------------------------------------


@query("b1_cast_schema", sql="""
SELECT row_id, CAST(total_count AS INTEGER) AS total_count, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat,
 CAST(precip AS DOUBLE) AS precip, CAST(snow AS DOUBLE) AS snow, CAST(temp AS DOUBLE) AS temp, CAST(wind AS DOUBLE) AS wind,
 CAST(hour AS INTEGER) AS hour, CAST(dow AS INTEGER) AS dow, CAST(month AS INTEGER) AS month FROM zone_obs""")
def b1_cast_schema(spark, sf):
    z = transform.cast_schema(zone_obs(spark, sf), io.OBS_SCHEMA)
    return z.select("row_id", *io.OBS_SCHEMA.fieldNames())


_T1_PARTS = ["round(ln(1 + total_count), 6) AS log_total_count",
             "round(sin(2e0 * pi() * CAST(hour AS DOUBLE) / 24e0), 6) AS hour_sin",
             "round(cos(2e0 * pi() * CAST(hour AS DOUBLE) / 24e0), 6) AS hour_cos",
             "round(sin(2e0 * pi() * CAST(dow AS DOUBLE) / 7e0), 6) AS dow_sin",
             "round(cos(2e0 * pi() * CAST(dow AS DOUBLE) / 7e0), 6) AS dow_cos",
             "round(sin(2e0 * pi() * (CAST(month AS DOUBLE) - 1e0) / 12e0), 6) AS month_sin",
             "round(cos(2e0 * pi() * (CAST(month AS DOUBLE) - 1e0) / 12e0), 6) AS month_cos"]
_T1_SQL = ", ".join(_T1_PARTS)
_T1_COLS = ["log_total_count", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]


@query("b2_feature_columns", sql=K + f"""
SELECT row_id, total_count, round(lon, 6) AS lon, round(lat, 6) AS lat, round(precip, 6) AS precip,
 round(snow, 6) AS snow, round(temp, 6) AS temp, round(wind, 6) AS wind, hour, dow, month, count_bin, time_period, {_T1_SQL}
FROM kz""")
def b2_feature_columns(spark, sf):
    z = pipeline.tier1_columns(keyed(spark, sf))
    cols = pipeline.feature_columns(z.drop("pred_a", "pred_b"))
    return z.select("row_id", *[r6(c) if c in {"lon", "lat", "precip", "snow", "temp", "wind", *_T1_COLS}
                                else F.col(c) for c in cols])


# the observed column on which each derived feature stands: a feature has a value where that column has one
_B3_FROM = {"snow": "row_id", "wind": "row_id", "log_total_count": "total_count", "count_bin": "total_count", "hour_sin": "hour", "hour_cos": "hour", "dow_sin": "dow",
            "dow_cos": "dow", "month_sin": "month", "month_cos": "month", "grid_te": "grid_id", "grid_period_te": "grid_period", "time_period": "hour",
            "is_raining": "precip", "has_snow": "row_id", "grid_avg_count": "grid_id", "grid_violation_std": "grid_id", "grid_sample_count": "grid_id"}
_B3_SETS = {**pipeline.cumulative_groups(), "pruned": [f for fs in pipeline.FEATURE_GROUPS.values() for f in fs if f not in pipeline.WEAK_FEATURES]}


@query("b3_feature_groups", sql=K + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{g}' AS feature_set, CAST({len(fs)} AS BIGINT) AS n_features, CAST((SELECT {' + '.join(f'count({_B3_FROM.get(f, f)})' for f in fs)} FROM ktr) AS BIGINT) AS train_values"
    for g, fs in _B3_SETS.items()) + ") t")
def b3_feature_groups(spark, sf):
    """Named incremental feature sets and the pruned one: their features in the train frame, and how many values these have there."""
    tr, te = keyed_split(spark, sf)
    ftr, _ = pipeline.features(tr, te)
    sets = {g: [f for f in fs if f in ftr.columns] for g, fs in _B3_SETS.items()}
    counts = ftr.agg(*[F.count(f).alias(f) for f in dict.fromkeys(f for fs in sets.values() for f in fs)])
    items = F.array(*[F.struct(F.lit(g).alias("feature_set"), F.lit(len(fs)).cast("long").alias("n_features"),
                               sum((F.col(f) for f in fs), F.lit(0).cast("long")).alias("train_values")) for g, fs in sets.items()])
    return counts.select(F.explode(items).alias("s")).select("s.*")


@query("b4_filter", sql="""
SELECT row_id, total_count, month FROM zone_obs WHERE total_count >= 5 AND month IN (1, 2, 3, 4, 5)""")
def b4_filter(spark, sf):
    z = zone_obs(spark, sf)
    return z.where((F.col("total_count") >= 5) & F.col("month").isin(1, 2, 3, 4, 5)).select("row_id", "total_count", "month")


@query("b5_trim_outliers", sql="""
, lim AS (SELECT quantile_cont(lon, 0.001) AS qlon, quantile_cont(lat, 0.001) AS qlat FROM zone_obs)
, kept AS (SELECT z.* FROM zone_obs z, lim WHERE z.lon > lim.qlon AND z.lat > lim.qlat)
SELECT count(*) AS kept_rows, round(100e0 * count(*) / (SELECT count(*) FROM zone_obs), 6) AS kept_pct,
 round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon, round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat FROM kept""")
def b5_trim_outliers(spark, sf):
    z = zone_obs(spark, sf)
    kept = transform.trim_outliers(z, ["lon", "lat"], 0.001)
    n_all = z.select(F.count(F.lit(1))).scalar()
    return kept.agg(F.count(F.lit(1)).alias("kept_rows"),
                    r6(F.count(F.lit(1)) * F.lit(100.0) / n_all, "kept_pct"),
                    r6(F.min("lon"), "min_lon"), r6(F.max("lon"), "max_lon"),
                    r6(F.min("lat"), "min_lat"), r6(F.max("lat"), "max_lat"))


@query("b6_fill_const", sql="SELECT row_id, round(coalesce(snow, 0e0), 6) AS snow FROM zone_obs")
def b6_fill_const(spark, sf):
    z = transform.fill_const(zone_obs(spark, sf), {"snow": 0.0})
    return z.select("row_id", r6("snow"))


@query("b7_median_fill", sql="""
, m AS (SELECT quantile_cont(wind, 0.5) AS med FROM zone_obs WHERE split = 'train')
SELECT z.row_id, z.split, round(coalesce(z.wind, m.med), 6) AS wind FROM zone_obs z, m""")
def b7_median_fill(spark, sf):
    z = zone_obs(spark, sf)
    med = transform.MedianFill("wind").fit(z.where("split = 'train'"))
    return med.apply(z).select("row_id", "split", r6("wind"))


@query("b8_fill_unseen", sql=K + """
, st AS (SELECT grid_id, avg(total_count) AS grid_avg_count, coalesce(stddev_samp(invalid_ratio), 0e0) AS grid_violation_std,
  CAST(count(invalid_ratio) AS DOUBLE) AS grid_sample_count FROM ktr GROUP BY grid_id)
, gl AS (SELECT (SELECT avg(total_count) FROM ktr) AS a, (SELECT stddev_samp(invalid_ratio) FROM ktr) AS s,
  (SELECT quantile_cont(c, 0.5) FROM (SELECT count(invalid_ratio) AS c FROM ktr GROUP BY grid_id) q) AS m)
SELECT t.row_id, round(coalesce(st.grid_avg_count, gl.a), 6) AS grid_avg_count,
 round(coalesce(st.grid_violation_std, gl.s), 6) AS grid_violation_std, round(coalesce(st.grid_sample_count, gl.m), 6) AS grid_sample_count
FROM kte t LEFT JOIN st ON t.grid_id = st.grid_id CROSS JOIN gl""")
def b8_fill_unseen(spark, sf):
    tr, te = keyed_split(spark, sf)
    st = transform.cell_stats(tr)
    out = transform.fill_unseen(te.join(st, on="grid_id", how="left"), transform.global_stats(tr))
    return out.select("row_id", r6("grid_avg_count"), r6("grid_violation_std"), r6("grid_sample_count"))


@query("b9_clip01", sql="""
SELECT row_id, round(least(greatest(1.2e0 * pred_b - 1e-1, 0e0), 1e0), 6) AS pred FROM zone_obs WHERE split = 'test'""")
def b9_clip01(spark, sf):
    z = zone_obs(spark, sf).where("split = 'test'")
    return z.select("row_id", r6(fx.clip01(F.lit(1.2) * F.col("pred_b") - F.lit(0.1)), "pred"))


@query("b10_overwrite_when", sql="""
SELECT row_id, round(CASE WHEN total_count = 1 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0))
 THEN 1e-1 ELSE ln(1 + total_count) END, 6) AS weight,
 round(CASE WHEN total_count = 1 AND pred_a < 0.15 AND invalid_ratio = 1e0 THEN 8e-1
 WHEN total_count = 1 AND pred_a > 0.85 AND invalid_ratio = 0e0 THEN 2e-1
 ELSE invalid_ratio END, 6) AS y_smooth FROM zone_obs WHERE split = 'train'""")
def b10_overwrite_when(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'").withColumn("weight", fx.sample_weight("total_count"))
    noise = transform.noise_candidates("pred_a", _Y)
    out = tr.withColumn("weight", transform.overwrite_when("weight", noise, 0.1)) \
        .withColumn("y_smooth", transform.overwrite_when(
            _Y, noise & (F.col(_Y) == 1.0), 0.8)) \
        .withColumn("y_smooth", transform.overwrite_when(
            "y_smooth", noise & (F.col(_Y) == 0.0), 0.2))
    return out.select("row_id", r6("weight"), r6("y_smooth"))


@query("b11_swap_columns", sql=K + S.full_enc_cte("e5", "(SELECT * FROM ktr WHERE month <= 5)", "grid_id", 100) + """
SELECT t.row_id, round(e5.te, 6) AS grid_te FROM kte t LEFT JOIN e5 ON t.grid_id = e5.grid_id""")
def b11_swap_columns(spark, sf):
    """Replace the full-train encoding on the scoring frame by a months-1-5 encoding."""
    tr, te = keyed_split(spark, sf)
    full = encode.fit_encoding(tr, "grid_id", _Y, 30.0)
    scored = encode.apply_encoding(te, full, "grid_id", "grid_te")
    sub = tr.where("month <= 5")
    enc5 = encode.fit_encoding(sub, "grid_id", _Y, 100.0)
    repl = encode.apply_encoding(te.select("row_id", "grid_id"), enc5, "grid_id", "grid_te")
    return transform.swap_columns(scored, repl, "row_id", ["grid_te"]).select("row_id", r6("grid_te"))


@query("b12_temp_column", sql="""
SELECT CASE WHEN total_count > 0 AND total_count <= 1 THEN '1' WHEN total_count <= 3 THEN '2-3'
 WHEN total_count <= 10 THEN '4-10' WHEN total_count <= 30 THEN '11-30' ELSE '31+' END AS count_label,
 count(*) AS n FROM zone_obs WHERE split = 'train' GROUP BY 1""")
def b12_temp_column(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    lab = tr.withColumn("count_label", fx.cut("total_count", labels=["1", "2-3", "4-10", "11-30", "31+"]))
    return lab.groupBy("count_label").agg(F.count(F.lit(1)).alias("n"))


@query("b13_noise_candidates", sql="""
SELECT row_id FROM zone_obs WHERE split = 'train' AND total_count = 1
 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0))""")
def b13_noise_candidates(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return tr.where(transform.noise_candidates("pred_a", _Y)).select("row_id")


@query("b14_confidence_layer", sql="""
SELECT layer, count(*) AS n FROM (SELECT CASE WHEN p < 0.02 OR p > 1 - 0.02 THEN 1 WHEN p < 0.10 OR p > 1 - 0.10 THEN 2 END AS layer
 FROM (SELECT least(greatest(pred_b, 0e0), 1e0) AS p FROM zone_obs WHERE split = 'test') a) b GROUP BY layer""")
def b14_confidence_layer(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'").withColumn("pred", fx.clip01("pred_b"))
    return te.select(transform.confidence_layer("pred").alias("layer")).groupBy("layer") \
        .agg(F.count(F.lit(1)).alias("n"))


# ---- C: scalar feature functions --------------------------------------------------------------


@query("c1_log_count", sql="SELECT row_id, round(ln(1 + total_count), 6) AS log_total_count FROM zone_obs")
def c1_log_count(spark, sf):
    return zone_obs(spark, sf).select("row_id", r6(fx.log_count(), "log_total_count"))


@query("c2_cut", sql=K + "SELECT count_bin, count(*) AS n FROM kz GROUP BY count_bin")
def c2_cut(spark, sf):
    return keyed(spark, sf).groupBy("count_bin").agg(F.count(F.lit(1)).alias("n"))


@query("c3_cyclical", sql=f"SELECT row_id, {', '.join(_T1_PARTS[1:])} FROM zone_obs")
def c3_cyclical(spark, sf):
    z = pipeline.tier1_columns(zone_obs(spark, sf))
    return z.select("row_id", *[r6(c) for c in _T1_COLS[1:]])


@query("c4_grid_cell", sql=K + "SELECT grid_id, min(grid_lon) AS grid_lon, min(grid_lat) AS grid_lat, count(*) AS n FROM kz GROUP BY grid_id")
def c4_grid_cell(spark, sf):
    z = keyed(spark, sf)
    return z.groupBy("grid_id").agg(F.min("grid_lon").alias("grid_lon"), F.min("grid_lat").alias("grid_lat"),
                                    F.count(F.lit(1)).alias("n"))


@query("c5_cross_key", sql=K + """
SELECT count(DISTINCT grid_period) AS n_grid_period, count(DISTINCT grid_id * 100 + CAST(month AS BIGINT)) AS n_grid_month,
 CAST(sum(grid_period % 1000) AS BIGINT) AS chk FROM ktr""")
def c5_cross_key(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return tr.agg(F.countDistinct("grid_period").alias("n_grid_period"),
                  F.countDistinct(fx.cross_key("grid_id", "month", 100)).alias("n_grid_month"),
                  F.sum(F.col("grid_period") % 1000).cast("long").alias("chk"))


@query("c6_time_period", sql=K + "SELECT hour, time_period, count(*) AS n FROM kz GROUP BY hour, time_period")
def c6_time_period(spark, sf):
    return keyed(spark, sf).groupBy("hour", "time_period").agg(F.count(F.lit(1)).alias("n"))


@query("c7_indicator", sql="""
SELECT CAST(precip > 0 AS INTEGER) AS is_raining, CAST(coalesce(snow, 0e0) > 0 AS INTEGER) AS has_snow, count(*) AS n
FROM zone_obs GROUP BY 1, 2""")
def c7_indicator(spark, sf):
    z = transform.fill_const(zone_obs(spark, sf), {"snow": 0.0})
    return z.select(fx.indicator("precip").alias("is_raining"), fx.indicator("snow").alias("has_snow")) \
        .groupBy("is_raining", "has_snow").agg(F.count(F.lit(1)).alias("n"))


@query("c8_sample_weight", sql="""
SELECT row_id, round(ln(1 + total_count), 6) AS weight,
 round(ln(1 + total_count) / (SELECT avg(ln(1 + total_count)) FROM zone_obs WHERE split = 'train'), 6) AS weight_norm
FROM zone_obs WHERE split = 'train'""")
def c8_sample_weight(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    out = fx.normalised_weight(tr, "total_count", "weight_norm").withColumn("weight", fx.sample_weight())
    return out.select("row_id", r6("weight"), r6("weight_norm"))


@query("c9_av_weight", sql="""
SELECT row_id, round(ln(1 + total_count) * pred_a, 6) AS av_weight FROM zone_obs WHERE split = 'train'""")
def c9_av_weight(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'").withColumnRenamed("pred_a", "p_test")
    return tr.select("row_id", r6(fx.av_weight("total_count", "p_test"), "av_weight"))


@query("c10_blend", sql="SELECT row_id, round(pred_a * 0.3 + pred_b * 0.7, 6) AS blend FROM zone_obs")
def c10_blend(spark, sf):
    return zone_obs(spark, sf).select("row_id", r6(fx.blend(["pred_a", "pred_b"], [0.3, 0.7]), "blend"))


_HEX_SQL = """
, hx_b AS (SELECT min({x}) AS xmin0, max({x}) AS xmax0, min({y}) AS ymin, max({y}) AS ymax FROM {src})
, hx_s AS (SELECT xmin0 - 1e-9 * (xmax0 - xmin0) AS xmin, ymin,
  ((xmax0 + 1e-9 * (xmax0 - xmin0)) - (xmin0 - 1e-9 * (xmax0 - xmin0))) / {nx}e0 AS sx, (ymax - ymin) / {ny}e0 AS sy FROM hx_b)
, hx_p AS (SELECT ({x} - xmin) / sx AS px, ({y} - ymin) / sy AS py, {val} AS v FROM {src}, hx_s)
, hx_q AS (SELECT *, round_even(px, 0) AS ix1, round_even(py, 0) AS iy1, floor(px) AS ix2, floor(py) AS iy2 FROM hx_p)
, hx_l AS (SELECT CASE WHEN (px - ix1) * (px - ix1) + 3e0 * (py - iy1) * (py - iy1) < (px - ix2 - 5e-1) * (px - ix2 - 5e-1)
  + 3e0 * (py - iy2 - 5e-1) * (py - iy2 - 5e-1) THEN 1 ELSE 2 END AS lattice, ix1, iy1, ix2, iy2, v FROM hx_q)
, hx_c0 AS (SELECT lattice, CAST(CASE WHEN lattice = 1 THEN ix1 ELSE ix2 END AS BIGINT) AS ix,
  CAST(CASE WHEN lattice = 1 THEN iy1 ELSE iy2 END AS BIGINT) AS iy, v FROM hx_l)
, hx_c AS (SELECT * FROM hx_c0 WHERE ix >= 0 AND iy >= 0 AND ix < CASE WHEN lattice = 1 THEN {nx} + 1 ELSE {nx} END
  AND iy < CASE WHEN lattice = 1 THEN {ny} + 1 ELSE {ny} END)
"""


@query("c11_hex_bin", sql=_HEX_SQL.format(x="lon", y="lat", src="zone_obs", nx=50, ny=28, val="invalid_ratio") + """
SELECT lattice, ix, iy, count(*) AS n, round(CAST(CAST(avg(v) AS FLOAT) AS DOUBLE), 6) AS mean_value FROM hx_c GROUP BY lattice, ix, iy HAVING count(*) >= 10""")
def c11_hex_bin(spark, sf):
    z = zone_obs(spark, sf)
    h = hex_bin(z, "lon", "lat", "invalid_ratio", gridsize=50, mincnt=10)
    return h.select("lattice", "ix", "iy", "n", r6f("mean_value"))


@query("c12_hex_density", sql=_HEX_SQL.format(x="pred_b", y="invalid_ratio", src="zone_obs", nx=80, ny=46, val="1") + """
SELECT lattice, ix, iy, count(*) AS n, round(log10(count(*)), 6) AS log_count FROM hx_c GROUP BY lattice, ix, iy""")
def c12_hex_density(spark, sf):
    z = zone_obs(spark, sf)
    h = hex_bin(z, "pred_b", "invalid_ratio", None, gridsize=80, mincnt=1)
    return h.select("lattice", "ix", "iy", "n", r6(F.log10("n"), "log_count"))


@query("c13_verdict", sql=K + """
SELECT count_bin, CASE WHEN avg(invalid_ratio) > 0.6 THEN 'HIGH' WHEN avg(invalid_ratio) < 0.4 THEN 'LOW' ELSE 'MID' END AS verdict,
 CASE WHEN abs(avg(invalid_ratio) - 0.5) > 0.3 THEN '***' WHEN abs(avg(invalid_ratio) - 0.5) > 0.1 THEN '**' ELSE '' END AS stars
FROM ktr GROUP BY count_bin""")
def c13_verdict(spark, sf):
    tr, _ = keyed_split(spark, sf)
    g = tr.groupBy("count_bin").agg(F.avg(_Y).alias("m"))
    m = F.col("m")
    return g.select("count_bin", fx.verdict(m, [(m > 0.6, "HIGH"), (m < 0.4, "LOW")], "MID").alias("verdict"),
                    fx.stars(m - F.lit(0.5)).alias("stars"))


@query("c14_label_map", sql=K + """
SELECT CASE time_period WHEN 0 THEN 'early_morn' WHEN 1 THEN 'morning_rush' WHEN 2 THEN 'late_morning' WHEN 3 THEN 'lunch_peak'
 WHEN 4 THEN 'afternoon' WHEN 5 THEN 'evening' END AS period_label, count(*) AS n, round(avg(invalid_ratio), 6) AS mean_ratio
FROM ktr GROUP BY 1""")
def c14_label_map(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return tr.groupBy(fx.period_label("time_period").alias("period_label")) \
        .agg(F.count(F.lit(1)).alias("n"), r6(F.avg(_Y), "mean_ratio"))
