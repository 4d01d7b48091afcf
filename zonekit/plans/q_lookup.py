"""Registered join and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode, lookup, transform
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_MU = "(SELECT avg(invalid_ratio) FROM ktr)"


@query("d1_lookup", sql=K + S.full_enc_cte("e", "ktr", "grid_id", 30) + """
SELECT t.row_id, round(e.te, 6) AS grid_te FROM kte t LEFT JOIN e ON t.grid_id = e.grid_id""")
def d1_lookup(spark, sf):
    tr, te = keyed_split(spark, sf)
    enc = encode.fit_encoding(tr, "grid_id", _Y, 30.0)
    return lookup.lookup(te, enc, "grid_id", "grid_te").select("row_id", r6("grid_te"))


@query("d2_join_stats", sql=K + """
, st AS (SELECT grid_id, avg(total_count) AS a, coalesce(stddev_samp(invalid_ratio), 0e0) AS s, count(invalid_ratio) AS n FROM ktr GROUP BY grid_id)
SELECT t.row_id, round(st.a, 6) AS grid_avg_count, round(st.s, 6) AS grid_violation_std, CAST(st.n AS DOUBLE) AS grid_sample_count
FROM kte t LEFT JOIN st ON t.grid_id = st.grid_id""")
def d2_join_stats(spark, sf):
    tr, te = keyed_split(spark, sf)
    j = lookup.join_stats(te, transform.cell_stats(tr), "grid_id")
    return j.select("row_id", r6("grid_avg_count"), r6("grid_violation_std"), "grid_sample_count")


@query("d3_unseen_keys", sql=K + """
SELECT t.grid_id, count(*) AS test_rows, round(100e0 * count(*) / (SELECT count(*) FROM kte), 6) AS test_pct
FROM kte t WHERE t.grid_id NOT IN (SELECT grid_id FROM ktr) GROUP BY t.grid_id""")
def d3_unseen_keys(spark, sf):
    tr, te = keyed_split(spark, sf)
    u = lookup.unseen_keys(te, tr, "grid_id")
    n_te = te.select(F.count(F.lit(1))).scalar()
    return u.select("grid_id", "test_rows", r6(F.col("test_rows") * F.lit(100.0) / n_te, "test_pct"))


@query("d4_semi", sql=K + """
SELECT row_id FROM ktr WHERE grid_id IN (SELECT grid_id FROM kte)""")
def d4_semi(spark, sf):
    tr, te = keyed_split(spark, sf)
    return lookup.semi(tr, te.select("grid_id").distinct(), "grid_id").select("row_id")


_D5 = K + """
, k AS (SELECT DISTINCT grid_lon AS gx, grid_lat AS gy FROM ktr)
, u AS (SELECT DISTINCT grid_lon AS gx, grid_lat AS gy FROM kte WHERE grid_id NOT IN (SELECT grid_id FROM ktr))
, d AS (SELECT u.gx AS ux, u.gy AS uy, k.gx AS kx, k.gy AS ky, (u.gx - k.gx) * (u.gx - k.gx) + (u.gy - k.gy) * (u.gy - k.gy) AS d2,
  row_number() OVER (PARTITION BY u.gx, u.gy ORDER BY (u.gx - k.gx) * (u.gx - k.gx) + (u.gy - k.gy) * (u.gy - k.gy), k.gx * 100000 + k.gy) AS rn
  FROM u CROSS JOIN k)
"""


def _nearest(spark, sf):
    tr, te = keyed_split(spark, sf)
    known = tr.select("grid_lon", "grid_lat").distinct()
    unseen = te.join(tr.select("grid_id").distinct(), on="grid_id", how="left_anti")
    return lookup.nearest_known(unseen, known, "grid_lon", "grid_lat")


@query("d5_nearest_fallback", sql=_D5 + """
SELECT ux AS grid_lon, uy AS grid_lat, kx AS near_x, ky AS near_y, round(sqrt(CAST(d2 AS DOUBLE)), 6) AS dist FROM d WHERE rn = 1""")
def d5_nearest_fallback(spark, sf):
    return _nearest(spark, sf).select("grid_lon", "grid_lat", "near_x", "near_y", r6("dist"))


@query("d5_mean_distance", sql=_D5 + """
SELECT count(*) AS cells, round(avg(sqrt(CAST(d2 AS DOUBLE))), 6) AS mean_dist, round(max(sqrt(CAST(d2 AS DOUBLE))), 6) AS max_dist FROM d WHERE rn = 1""")
def d5_mean_distance(spark, sf):
    """How far the fallback reaches: unseen cells, mean and largest distance in cells."""
    n = _nearest(spark, sf).agg(F.count(F.lit(1)).alias("cells"), F.avg("dist").alias("mean_dist"), F.max("dist").alias("max_dist"))
    return n.select("cells", r6("mean_dist"), r6("max_dist"))


@query("d6_coalesce_chain", sql=K + S.full_enc_cte("ec", "ktr", "grid_id", 100) + S.full_enc_cte("ep", "ktr", "grid_period", 150) + """
, k AS (SELECT DISTINCT grid_id, grid_lon, grid_lat FROM ktr)
, kn AS (SELECT k.grid_lon AS gx, k.grid_lat AS gy, ec.te FROM k JOIN ec ON k.grid_id = ec.grid_id)
, u AS (SELECT DISTINCT grid_lon AS gx, grid_lat AS gy FROM kte WHERE grid_id NOT IN (SELECT grid_id FROM ktr))
, nn AS (SELECT ux, uy, te FROM (SELECT u.gx AS ux, u.gy AS uy, kn.te, row_number() OVER (PARTITION BY u.gx, u.gy
  ORDER BY (u.gx - kn.gx) * (u.gx - kn.gx) + (u.gy - kn.gy) * (u.gy - kn.gy), kn.gx * 100000 + kn.gy) AS rn FROM u CROSS JOIN kn) z WHERE rn = 1)
SELECT t.row_id, round(coalesce(ep.te, ec.te, nn.te, """ + _MU + """), 6) AS grid_period_te
FROM kte t LEFT JOIN ec ON t.grid_id = ec.grid_id LEFT JOIN ep ON t.grid_period = ep.grid_period
LEFT JOIN nn ON t.grid_lon = nn.ux AND t.grid_lat = nn.uy""")
def d6_coalesce_chain(spark, sf):
    """Cross encoding -> cell encoding (nearest known cell when unseen) -> global mean."""
    tr, te = keyed_split(spark, sf)
    stats = encode.stored_stats(tr, ["grid_id", "grid_lon", "grid_lat", "grid_period"], _Y)
    mu = encode.mean_of(stats)
    ec = encode.full_table(stats, "grid_id", 100.0, mu)
    ep = encode.full_table(stats, "grid_period", 150.0, mu)
    cells = stats.select("grid_id", "grid_lon", "grid_lat").distinct()
    t = lookup.fill_from_nearest(te, ec, "grid_id", "grid_te", cells=cells)
    t = lookup.lookup(t, ep, "grid_period", "gp_te")
    return t.select("row_id", r6(lookup.coalesce_chain(["gp_te", "grid_te", mu]), "grid_period_te"))


@query("d7_with_scalars", sql=K + """
SELECT row_id, round(invalid_ratio - (SELECT avg(invalid_ratio) FROM ktr), 6) AS centred,
 round((SELECT stddev_samp(invalid_ratio) FROM ktr), 6) AS global_std FROM ktr""")
def d7_with_scalars(spark, sf):
    tr, _ = keyed_split(spark, sf)
    one = tr.agg(F.avg(_Y).alias("mu"), F.stddev_samp(_Y).alias("global_std"))
    w = lookup.with_scalars(tr, one)
    return w.select("row_id", r6(F.col(_Y) - F.col("mu"), "centred"), r6("global_std"))


@query("d8_align", sql=K + S.kfold_cte("e", "ktr", "grid_id", 30) + """
SELECT g.row_id, round(g.pred_a, 6) AS pred_a, round(g.pred_b, 6) AS pred_b, round(e.te, 6) AS grid_te
FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold""")
def d8_align(spark, sf):
    """Three models' predictions in long form, aligned back on the row id."""
    tr, _ = keyed_split(spark, sf)
    enc = encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "grid_te")
    long = enc.select("row_id", F.explode(F.array(
        F.struct(F.lit("pred_a").alias("model"), F.col("pred_a").alias("pred")),
        F.struct(F.lit("pred_b").alias("model"), F.col("pred_b").alias("pred")),
        F.struct(F.lit("grid_te").alias("model"), F.col("grid_te").alias("pred")))).alias("p")).select("row_id", "p.*")
    a = lookup.align(long, ["pred_a", "pred_b", "grid_te"])
    return a.select("row_id", r6("pred_a"), r6("pred_b"), r6("grid_te"))
