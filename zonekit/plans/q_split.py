"""Registered splitting, sampling and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split, transform
from ..sources.fixtures import zone_obs
from . import sqltext as S
from .registry import query, r6

_Y = "invalid_ratio"
_NOISE = "(total_count = 1 AND ((pred_a < 0.15 AND invalid_ratio = 1e0) OR (pred_a > 0.85 AND invalid_ratio = 0e0)))"


@query("i1_assign_fold", sql=f"SELECT row_id, {S.fold_sql(5)} AS fold FROM zone_obs WHERE split = 'train'")
def i1_assign_fold(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return split.assign_fold(tr, 5).select("row_id", "fold")


@query("i2_assign_stratified_fold", sql=f"""
, lab AS (SELECT row_id, CASE WHEN split = 'test' THEN 1 ELSE 0 END AS is_test FROM zone_obs)
SELECT row_id, is_test, CAST((row_number() OVER (PARTITION BY is_test ORDER BY {S.mix_sql()}, row_id) - 1) % 5 AS INTEGER) AS fold FROM lab""")
def i2_assign_stratified_fold(spark, sf):
    z = zone_obs(spark, sf).select("row_id", F.when(F.col("split") == "test", 1).otherwise(0).alias("is_test"))
    return split.assign_stratified_fold(z, "is_test", 5).select("row_id", "is_test", "fold")


@query("i3_sample_n", sql=f"""
SELECT row_id FROM zone_obs WHERE split = 'train' ORDER BY {S.mix_sql(seed=42)}, row_id LIMIT 20000""")
def i3_sample_n(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return split.sample_n(tr, 20000, seed=42).select("row_id")


@query("i4_sample_stratum", sql=f"""
SELECT row_id FROM zone_obs WHERE split = 'train' AND total_count = 1 ORDER BY {S.mix_sql(seed=7)}, row_id LIMIT 500""")
def i4_sample_stratum(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return split.sample_stratum(tr, F.col("total_count") == 1, 500, seed=7).select("row_id")


@query("i5_balance", sql=f"""
SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY {S.mix_sql(seed=3)}, row_id) AS rn FROM zone_obs WHERE split = 'train') t
WHERE rn <= (SELECT count(*) FROM zone_obs WHERE split = 'test')""")
def i5_balance(spark, sf):
    z = zone_obs(spark, sf)
    return split.balance(z.where("split = 'train'"), z.where("split = 'test'"), seed=3).select("row_id")


@query("i6_temporal_split", sql="""
SELECT CASE WHEN month IN (1, 2, 3, 4) THEN 'fit' ELSE 'valid' END AS part, count(*) AS n, round(avg(invalid_ratio), 6) AS mean_ratio
FROM zone_obs WHERE split = 'train' AND month IN (1, 2, 3, 4, 5) GROUP BY 1""")
def i6_temporal_split(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    fit, valid = split.temporal_split(tr)
    def summ(d, name):
        return d.agg(F.count(F.lit(1)).alias("n"), r6(F.avg(_Y), "mean_ratio")).select(F.lit(name).alias("part"), "n", "mean_ratio")
    return summ(fit, "fit").unionByName(summ(valid, "valid"))


@query("i7_label_sources", sql="""
SELECT CASE WHEN split = 'test' THEN 1 ELSE 0 END AS is_test, count(*) AS n, round(avg(pred_a), 6) AS mean_pred_a FROM zone_obs GROUP BY 1""")
def i7_label_sources(spark, sf):
    z = zone_obs(spark, sf)
    u = split.label_sources(z.where("split = 'train'"), z.where("split = 'test'"), ["row_id", "pred_a"])
    return u.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("pred_a"), "mean_pred_a"))


@query("i8_augment_fold", sql=f"""
, tr AS (SELECT *, {S.fold_sql(5)} AS fold FROM zone_obs WHERE split = 'train')
, ps AS (SELECT row_id, (least(greatest(pred_a, 0e0), 1e0) + least(greatest(pred_b, 0e0), 1e0)) / 2e0 AS y FROM zone_obs
  WHERE split = 'test')
, lay AS (SELECT * FROM ps WHERE y < 0.02 OR y > 1 - 0.02 OR y < 0.10 OR y > 1 - 0.10)
SELECT 'fit' AS role, 0 AS is_pseudo, count(*) AS n FROM tr WHERE fold <> 0
UNION ALL SELECT 'fit', 1, count(*) FROM lay
UNION ALL SELECT 'valid', 0, count(*) FROM tr WHERE fold = 0""")
def i8_augment_fold(spark, sf):
    z = zone_obs(spark, sf)
    tr = split.assign_fold(z.where("split = 'train'"), 5)
    ps = split.pseudo_labels(z.where("split = 'test'"), ["pred_a", "pred_b"]).select("row_id", F.col("pseudo_y").alias(_Y), "weight")
    fit, valid = split.augment_fold(tr.select("row_id", _Y, "fold"), ps, 0)
    f = fit.groupBy("is_pseudo").agg(F.count(F.lit(1)).alias("n")).select(F.lit("fit").alias("role"), "is_pseudo", "n")
    v = valid.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("role"), F.lit(0).alias("is_pseudo"), "n")
    return f.unionByName(v)


@query("i9_pseudo_labels", sql="""
, ps AS (SELECT row_id, (least(greatest(pred_a, 0e0), 1e0) + least(greatest(pred_b, 0e0), 1e0)) / 2e0 AS y FROM zone_obs WHERE split = 'test')
, lay AS (SELECT row_id, y, CASE WHEN y < 0.02 OR y > 1 - 0.02 THEN 1 WHEN y < 0.10 OR y > 1 - 0.10 THEN 2 END AS layer FROM ps)
SELECT row_id, layer, round(y, 6) AS pseudo_y, CASE WHEN layer = 1 THEN 0.7e0 ELSE 0.3e0 END AS weight FROM lay WHERE layer IS NOT NULL""")
def i9_pseudo_labels(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'")
    p = split.pseudo_labels(te, ["pred_a", "pred_b"])
    return p.select("row_id", "layer", r6("pseudo_y"), "weight")


@query("i10_exclude_noise", sql=f"""
, tr AS (SELECT *, {S.fold_sql(5)} AS fold FROM zone_obs WHERE split = 'train')
SELECT 'fit' AS role, count(*) AS n FROM tr WHERE fold <> 0 AND NOT {_NOISE}
UNION ALL SELECT 'valid', count(*) FROM tr WHERE fold = 0""")
def i10_exclude_noise(spark, sf):
    tr = split.assign_fold(zone_obs(spark, sf).where("split = 'train'"), 5)
    fit, valid = split.exclude_noise_train_only(tr, transform.noise_candidates("pred_a", _Y), 0)
    return fit.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fit").alias("role"), "n") \
        .unionByName(valid.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("role"), "n"))
