"""Registered validation and report queries (M1-M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import checks, encode, stats
from ..operators import ensemble as E
from ..sources.fixtures import zone_obs
from . import pipeline, q_ensemble
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_M1_COLS = ["total_count", "precip", "snow", "temp", "wind", "hour", "dow", "month"]


@query("m1_assert_no_null", sql="""
, m AS (SELECT quantile_cont(wind, 0.5) AS med FROM zone_obs WHERE split = 'train')
, f AS (SELECT total_count, precip, coalesce(snow, 0e0) AS snow, temp, coalesce(wind, (SELECT med FROM m)) AS wind, hour, dow, month FROM zone_obs)
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls, round(100e0 * (count(*) - count({c})) / count(*), 6) AS null_pct, "
    f"CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM f" for c in _M1_COLS) + ") t")
def m1_assert_no_null(spark, sf):
    z = zone_obs(spark, sf)
    a, b = pipeline.fill_missing(z.where("split = 'train'"), z.where("split = 'test'"))
    c = checks.assert_no_null(a.unionByName(b), _M1_COLS)
    return c.select("column", "nulls", r6("null_pct"), "status")


@query("m2_check_predictions", sql="""
, p AS (SELECT least(greatest(0.5e0 * pred_a + 0.5e0 * pred_b, 0e0), 1e0) AS pred FROM zone_obs WHERE split = 'test')
, a AS (SELECT CAST(sum(CASE WHEN pred IS NULL OR isnan(pred) THEN 1 ELSE 0 END) AS DOUBLE) AS nulls, CAST(count(*) AS DOUBLE) AS rows,
  min(pred) AS mn, max(pred) AS mx, abs(avg(pred) - (SELECT avg(invalid_ratio) FROM zone_obs WHERE split = 'train')) AS gap,
  CAST((SELECT count(*) FROM zone_obs WHERE split = 'test') AS DOUBLE) AS expected FROM p)
SELECT 'nulls' AS "check", round(nulls, 6) AS value, CASE WHEN nulls = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM a
UNION ALL SELECT 'rows', round(rows, 6), CASE WHEN rows = expected THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'min', round(mn, 6), CASE WHEN mn >= 0 THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'max', round(mx, 6), CASE WHEN mx <= 1 THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'mean_gap', round(gap, 6), CASE WHEN gap < 0.05 THEN 'PASS' ELSE 'FAIL' END FROM a""")
def m2_check_predictions(spark, sf):
    z = zone_obs(spark, sf)
    te = z.where("split = 'test'")
    pred = te.select(fx.clip01(fx.blend(["pred_a", "pred_b"], [0.5, 0.5])).alias("pred"))
    c = checks.check_predictions(pred, "pred", te.select(F.count(F.lit(1))).scalar(),
                                 z.where("split = 'train'").select(F.avg(_Y)).scalar())
    return c.select("check", r6("value"), "status")


_M3_BOTH = ["row_id", "total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month", "grid_id", "count_bin", "time_period", "grid_period"]


@query("m3_check_columns", sql=K + "SELECT * FROM (" + " UNION ALL ".join(
    [f"SELECT '{c}' AS column, (SELECT count({c}) FROM ktr) AS train_values, (SELECT count({c}) FROM kte) AS test_values, 'PASS' AS status" for c in _M3_BOTH]
    + ["SELECT 'invalid_ratio', (SELECT count(invalid_ratio) FROM ktr), NULL, 'TRAIN_ONLY'", "SELECT 'fold', (SELECT count(fold) FROM ktr), NULL, 'TRAIN_ONLY'"]) + ") t")
def m3_check_columns(spark, sf):
    """Keyed train rows against scoring rows, which have neither target nor fold: the values of every column on both sides."""
    tr, te = keyed_split(spark, sf)
    return checks.check_columns(tr.select(*_M3_BOTH, _Y, "fold"), te.select(*_M3_BOTH))


@query("m4_check_rows", sql=K + S.kfold_cte("ec", "ktr", "grid_id", 30) + S.kfold_cte("ep", "ktr", "grid_period", 50) + """
SELECT rows_before, rows_after, CASE WHEN rows_before = rows_after THEN 'PASS' ELSE 'FAIL' END AS status FROM
 (SELECT (SELECT count(*) FROM ktr) AS rows_before, (SELECT count(*) FROM ktr g JOIN ec ON g.grid_id = ec.grid_id AND g.fold = ec.fold
   JOIN ep ON g.grid_period = ep.grid_period AND g.fold = ep.fold JOIN (SELECT grid_id, count(*) n FROM ktr GROUP BY grid_id) st ON st.grid_id = g.grid_id) AS rows_after) t""")
def m4_check_rows(spark, sf):
    tr, te = keyed_split(spark, sf)
    ftr, _ = pipeline.features(tr, te)
    return checks.check_rows(tr, ftr)


_HIST_CTES = ""
for _i, _m in enumerate(["pred_a", "pred_b"]):
    _c, _r = S.spearman_sql("(SELECT * FROM zone_obs WHERE split = 'train')", _m, "invalid_ratio", [], f"h{_i}")
    _HIST_CTES += _c + f", v{_i} AS (SELECT {_r} AS rho FROM h{_i}_j)"


@query("m5_history", sql=_HIST_CTES + """
, v AS (SELECT 1 AS version, 'pred_a' AS model, (SELECT rho FROM v0) AS score UNION ALL SELECT 2, 'pred_b', (SELECT rho FROM v1))
SELECT version, model, round(score, 6) AS score, round(score - lag(score) OVER (ORDER BY version), 6) AS delta FROM v""")
def m5_history(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    s = stats.spearman_pairs(tr, [("pred_a", _Y), ("pred_b", _Y)]) \
        .select(F.when(F.col("a") == "pred_a", 1).otherwise(2).alias("version"), F.col("a").alias("model"), F.col("rho").alias("score"))
    h = checks.history(s)
    return h.select("version", "model", r6("score"), r6("delta"))


@query("m6_gate")
def m6_gate(spark, sf):
    """Run the layer-2 step only if the layer-1 score holds (driver-side decision on one value)."""
    tr = zone_obs(spark, sf).where("split = 'train'")
    rho = stats.spearman(tr, "pred_b", _Y).collect()[0]["rho"]
    go = checks.gate(rho, 0.5)
    return spark.range(1).select(F.lit(rho).alias("score"), F.lit(0.5).alias("limit"), F.lit(go).alias("run_next"))


_M7_C, _M7_R = S.spearman_sql("(SELECT 'pred_a' AS model, 'all' AS seg, pred_a AS p, invalid_ratio FROM zone_obs WHERE split = 'train' "
                              "UNION ALL SELECT 'pred_b', 'all', pred_b, invalid_ratio FROM zone_obs WHERE split = 'train' "
                              "UNION ALL SELECT 'pred_a', 'tc1', pred_a, invalid_ratio FROM zone_obs WHERE split = 'train' AND total_count = 1 "
                              "UNION ALL SELECT 'pred_b', 'tc1', pred_b, invalid_ratio FROM zone_obs WHERE split = 'train' AND total_count = 1)",
                              "p", "invalid_ratio", ["model", "seg"], "s")


@query("m7_compare", sql=_M7_C + f"""
, sc AS (SELECT model, seg, {_M7_R} AS rho FROM s_j GROUP BY model, seg)
SELECT a.model, round(a.rho, 6) AS rho, round(b.rho, 6) AS rho_tc1, round(a.rho - (SELECT rho FROM sc WHERE model = 'pred_a' AND seg = 'all'), 6) AS delta,
 CASE WHEN a.rho >= (SELECT max(rho) FROM sc WHERE seg = 'all') THEN 'BEST' ELSE '' END AS status
FROM sc a JOIN sc b ON a.model = b.model AND a.seg = 'all' AND b.seg = 'tc1'""")
def m7_compare(spark, sf):
    """Per-model score on all rows and on the tc=1 segment, delta to the base model."""
    tr = zone_obs(spark, sf).where("split = 'train'")
    long = tr.select(_Y, "total_count", F.explode(F.array(
        F.struct(F.lit("pred_a").alias("model"), F.col("pred_a").alias("p")),
        F.struct(F.lit("pred_b").alias("model"), F.col("pred_b").alias("p")))).alias("m")).select(_Y, "total_count", "m.*")
    segs = long.select("model", "p", _Y, F.explode(F.array(F.lit("all"), F.when(F.col("total_count") == 1, "tc1"))).alias("seg")) \
        .where(F.col("seg").isNotNull())
    sc = stats.spearman(segs, "p", _Y, by=["model", "seg"])
    a = sc.where("seg = 'all'").select("model", "rho")
    b = sc.where("seg = 'tc1'").select("model", F.col("rho").alias("rho_tc1"))
    base = a.where("model = 'pred_a'").select("rho").scalar()
    best = a.select(F.max("rho")).scalar()
    return a.join(b, on="model").select("model", r6("rho"), r6("rho_tc1"), r6(F.col("rho") - base, "delta"),
                                        F.when(F.col("rho") >= best, "BEST").otherwise("").alias("status"))


_M7_PAIRS = {"plain": ("pred_a", "pred_b"), "cell": ("grid_te", "pred_b"), "period": ("grid_period_te", "pred_b")}
_M7_LONG = " UNION ALL ".join(f"SELECT '{s}{sub}' AS k, '{s}' AS strategy, {a} AS a, {b} AS b, {_Y} FROM enc{where}" for s, (a, b) in _M7_PAIRS.items()
                              for sub, where in (("", ""), (":sub", " WHERE month <= 5")))


@query("m7_strategies", sql=K + q_ensemble._ENC + f", lg AS ({_M7_LONG})" + q_ensemble.curve_sql("lg", ["a", "b"], by="k") + """
, r AS (SELECT strategy, corr(a, b) AS correlation FROM lg WHERE k = strategy GROUP BY strategy)
, t AS (SELECT k AS strategy, arg_max(c.point, (c.rho, -c.point)) AS point, max(c.rho) AS rho, max(CASE WHEN w.i1 = 0 THEN c.rho END) AS rho_a,
  max(CASE WHEN w.i0 = 0 THEN c.rho END) AS rho_b FROM c JOIN c_w w ON w.point = c.point WHERE k NOT LIKE '%:sub' GROUP BY k)
, u AS (SELECT t.*, w.i0 / 20e0 AS weight_a, w.i1 / 20e0 AS weight_b, s.rho AS rho_subset, correlation FROM t JOIN c_w w ON w.point = t.point
  LEFT JOIN c s ON s.k = t.strategy || ':sub' AND s.point = t.point JOIN r ON r.strategy = t.strategy)
, b AS (SELECT rho, rho_subset FROM u WHERE strategy = 'plain')
SELECT strategy, round(rho_a, 6) AS rho_a, round(rho_b, 6) AS rho_b, round(rho, 6) AS rho, round(rho_subset, 6) AS rho_subset, round(correlation, 6) AS correlation,
 round(weight_a, 6) AS weight_a, round(weight_b, 6) AS weight_b, round(rho - (SELECT rho FROM b), 6) AS delta,
 round(rho_subset - (SELECT rho_subset FROM b), 6) AS delta_subset, CASE WHEN strategy = (SELECT min(strategy) FROM u WHERE rho = (SELECT max(rho) FROM u)) THEN 'BEST'
 WHEN rho >= (SELECT rho FROM b) - 0.0005 THEN 'PASS' ELSE 'FAIL' END AS status FROM u""")
def m7_strategies(spark, sf):
    """Three strategies, each a pair of predictions: scores, best weights, months 1-5, correlation, deltas and status."""
    d = q_ensemble._enc_train(spark, sf)
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(a).alias("a"), F.col(b).alias("b")) for s, (a, b) in _M7_PAIRS.items()])).alias("m")
    t = E.compare_strategies(d.select(_Y, "month", pairs).select(_Y, "month", "m.*"), "strategy", "a", "b", _Y, F.col("month") <= 5, "plain")
    return t.select("strategy", *[r6(c) for c in ("rho_a", "rho_b", "rho", "rho_subset", "correlation", "weight_a", "weight_b", "delta", "delta_subset")], "status")


_M8_C, _M8_R = S.spearman_sql("(SELECT month, split, 0.5e0 * pred_a + 0.5e0 * pred_b AS p, invalid_ratio FROM zone_obs)",
                              "p", "invalid_ratio", ["split", "month"], "s")


@query("m8_score_series", sql=_M8_C + f"""
SELECT split, month, count(*) AS n, round({_M8_R}, 6) AS rho FROM s_j GROUP BY split, month""")
def m8_score_series(spark, sf):
    """Score series of the fixed blend per month, offline (train) and held-out (test)."""
    z = zone_obs(spark, sf).select("split", "month", _Y, fx.blend(["pred_a", "pred_b"], [0.5, 0.5]).alias("p"))
    return stats.spearman(z, "p", _Y, by=["split", "month"], with_n=True).select("split", "month", "n", r6("rho"))
