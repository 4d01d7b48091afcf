"""Registered source and sink queries (A1-A10).

Each writes what a job would write (CSV input, parquet tiers, encoder maps,
submissions, per-fold checkpoints) under the shared folder and returns what a
reader gets back, so the oracle can check the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode
from ..session import scratch_path
from ..sources import io
from ..sources.fixtures import zone_obs
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_OBS = ["row_id", "total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month"]


@query("a1_read_observations", sql=f"SELECT {', '.join(_OBS)} FROM zone_obs WHERE split = 'train'")
def a1_read_observations(spark, sf):
    """Typed CSV scan of an observation file (written here from the bound view)."""
    path = scratch_path(spark, "x_train_csv")
    zone_obs(spark, sf).where("split = 'train'").select(*_OBS).write.option("header", True).csv(path)
    return io.read_observations(spark, path)


@query("a2_attach_target", sql="""
, tr AS (SELECT * FROM zone_obs WHERE split = 'train')
SELECT x.row_id, x.total_count, round(x.lon, 6) AS lon, y.invalid_ratio FROM tr x JOIN tr y ON x.row_id = y.row_id""")
def a2_attach_target(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    x = tr.select("row_id", "total_count", "lon")
    y = tr.select("row_id", _Y)
    return io.attach_target(x, y).select("row_id", "total_count", r6("lon"), _Y)


@query("a3_save_tier", sql=K + S.kfold_cte("e", "ktr", "grid_id", 30) + """
SELECT g.row_id, g.grid_id, round(ln(1 + g.total_count), 6) AS log_total_count, round(e.te, 6) AS grid_te
FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold""")
def a3_save_tier(spark, sf):
    """Tier-1 parquet checkpoint, re-read (the later steps start from the files)."""
    tr, _ = keyed_split(spark, sf)
    t1 = encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "grid_te") \
        .select("row_id", "grid_id", fx.log_count().alias("log_total_count"), "grid_te")
    back = io.save_tier(t1, scratch_path(spark, "tier1"))
    return back.select("row_id", "grid_id", r6("log_total_count"), r6("grid_te"))


@query("a4_pruned_scan", sql="SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 49")
def a4_pruned_scan(spark, sf):
    """Two columns of a wide parquet table; only they are read (ReadSchema) and the filter is pushed."""
    return io.read_columns(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"]).where(F.col("l_quantity") >= 49)


@query("a5_save_encoder", sql=K + S.full_enc_cte("ec", "ktr", "grid_id", 30) + S.full_enc_cte("ep", "ktr", "grid_period", 50) + """
SELECT 'grid' AS encoder, grid_id AS key, round(te, 6) AS te, n FROM ec UNION ALL SELECT 'grid_period', grid_period, round(te, 6), n FROM ep""")
def a5_save_encoder(spark, sf):
    tr, _ = keyed_split(spark, sf)
    mu = encode.global_mean(tr, _Y)
    maps = {"grid": encode.fit_encoding(tr, "grid_id", _Y, 30.0, mu),
            "grid_period": encode.fit_encoding(tr, "grid_period", _Y, 50.0, mu)}
    consts = tr.agg(F.avg(_Y).alias("global_mean"), F.lit(fx.GRID_SIZE).alias("grid_size"))
    m, _ = io.save_encoder(maps, consts, scratch_path(spark, "encoders"))
    return m.select("encoder", "key", r6("te"), "n")


@query("a6_write_submission", sql="""
SELECT row_id, round(least(greatest(1.1e0 * pred_b - 5e-2, 0e0), 1e0), 6) AS invalid_ratio FROM zone_obs WHERE split = 'test'""")
def a6_write_submission(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'")
    pred = te.select("row_id", (F.lit(1.1) * F.col("pred_b") - F.lit(0.05)).alias("pred"))
    return io.write_submission(pred, scratch_path(spark, "sub")).select("row_id", r6(_Y))


@query("a7_rekey", sql="""
SELECT t.row_id, round(p.pred_a, 6) AS pred FROM (SELECT row_id FROM zone_obs WHERE split = 'test') t
LEFT JOIN (SELECT row_id, pred_a FROM zone_obs WHERE split = 'test' AND month <= 5) p ON t.row_id = p.row_id""")
def a7_rekey(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'")
    pred = te.where("month <= 5").select("row_id", F.col("pred_a").alias("pred"))
    return io.rekey(te.select("row_id"), pred).select("row_id", r6("pred"))


def _fold_models(spark, sf, path):
    """Per-fold 'models': the encoding fitted on the other folds scores the held-out fold and the test rows."""
    tr, te = keyed_split(spark, sf)
    mu = encode.global_mean(tr, _Y)
    done = set(io.fold_done(spark, path, "te_model"))
    for k in range(5):
        if k in done:
            continue
        fit = tr.where(F.col("fold") != k)
        enc = encode.fit_encoding(fit, "grid_id", _Y, 30.0, mu)
        oof = encode.apply_encoding(tr.where(F.col("fold") == k), enc, "grid_id", "pred", fill=encode.as_stored(mu))
        tst = encode.apply_encoding(te, enc, "grid_id", "pred", fill=encode.as_stored(mu))
        out = oof.select("row_id", F.lit("oof").alias("kind"), "pred").unionByName(
            tst.select("row_id", F.lit("test").alias("kind"), "pred"))
        io.checkpoint_fold(out, path, "te_model", k)


@query("a8_checkpoint_fold")
def a8_checkpoint_fold(spark, sf):
    """Folds are written one by one; a rerun skips finished folds (here: the second call writes nothing)."""
    path = scratch_path(spark, "folds")
    _fold_models(spark, sf, path)
    _fold_models(spark, sf, path)
    return spark.read.parquet(path).groupBy("model", "fold", "kind").agg(F.count(F.lit(1)).alias("n"))


_A9 = K + """
, fs AS (SELECT g.grid_id, g.fold AS f, sum(g.invalid_ratio) s, count(*) n FROM ktr g GROUP BY g.grid_id, g.fold)
, folds AS (SELECT DISTINCT fold AS k FROM ktr)
, enc AS (SELECT folds.k, fs.grid_id, CAST(CAST((sum(fs.s) + 30 * (SELECT avg(invalid_ratio) FROM ktr)) / (sum(fs.n) + 30) AS FLOAT) AS DOUBLE) AS te
  FROM folds JOIN fs ON fs.f <> folds.k GROUP BY folds.k, fs.grid_id)
, mu AS (SELECT CAST(CAST(avg(invalid_ratio) AS FLOAT) AS DOUBLE) AS m FROM ktr)
"""


@query("a9_recover_predictions", sql=_A9 + """
SELECT 'oof' AS kind, g.row_id, round(coalesce(enc.te, (SELECT m FROM mu)), 6) AS pred, CAST(1 AS BIGINT) AS n_folds
 FROM ktr g LEFT JOIN enc ON enc.k = g.fold AND enc.grid_id = g.grid_id
UNION ALL SELECT 'test', t.row_id, round(avg(coalesce(enc.te, (SELECT m FROM mu))), 6), count(*) FROM kte t CROSS JOIN folds
 LEFT JOIN enc ON enc.k = folds.k AND enc.grid_id = t.grid_id GROUP BY t.row_id""")
def a9_recover_predictions(spark, sf):
    """OOF predictions from each fold's own rows; test prediction = mean over the five folds."""
    path = scratch_path(spark, "folds")
    _fold_models(spark, sf, path)
    oof, test = io.recover_predictions(spark, path, "te_model")
    return oof.select(F.lit("oof").alias("kind"), "row_id", r6("pred"), F.lit(1).cast("long").alias("n_folds")) \
        .unionByName(test.select(F.lit("test").alias("kind"), "row_id", r6("pred"), "n_folds"))


@query("a10_load_first")
def a10_load_first(spark, sf):
    """The first prediction version that exists wins (a missing newer version is skipped)."""
    base = scratch_path(spark, "versions")
    zone_obs(spark, sf).where("split = 'test'").select("row_id", F.col("pred_b").alias("pred")) \
        .write.mode("overwrite").parquet(f"{base}/v7")
    chosen, df = io.load_first(spark, [f"{base}/v9", f"{base}/v8", f"{base}/v7"])
    return df.withColumn("version", F.lit(chosen.rsplit("/", 1)[1]))
