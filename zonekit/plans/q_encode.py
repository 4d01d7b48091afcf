"""Registered target-encoding queries (H1-H8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode
from . import pipeline
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)


@query("h2_kfold_encode", sql=S.keyed_cte(5) + S.kfold_cte("e", "ktr", "grid_id", 30) + """
SELECT g.row_id, round(e.te, 6) AS grid_te FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold""")
def h2_kfold_encode(spark, sf):
    tr, _ = keyed_split(spark, sf)
    out = encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "grid_te")
    return out.select("row_id", r6("grid_te"))


def _mu_sql(src: str = "ktr") -> str:
    return f"CAST(CAST((SELECT avg(invalid_ratio) FROM {src}) AS FLOAT) AS DOUBLE)"


@query("h1_fit_encoding", sql=K + S.full_enc_cte("e", "ktr", "grid_id", 30) + """
SELECT grid_id, round(te, 6) AS te, n FROM e""")
def h1_fit_encoding(spark, sf):
    tr, _ = keyed_split(spark, sf)
    return encode.fit_encoding(tr, "grid_id", _Y, 30.0).select("grid_id", r6("te"), "n")


_V2 = (S.kfold_extra(10, "fold10") + ", k2tr AS (SELECT * FROM kz_fold10 WHERE split = 'train')"
       + S.kfold_cte("e2", "k2tr", "grid_id", 100, fold="fold10") + S.full_enc_cte("f2", "k2tr", "grid_id", 100))


@query("h3_kfold_encode_v2", sql=K + _V2 + f"""
SELECT 'train' AS split, g.row_id, round(coalesce(e2.te, {_mu_sql()}), 6) AS grid_te FROM k2tr g
 LEFT JOIN e2 ON g.grid_id = e2.grid_id AND g.fold10 = e2.fold10
UNION ALL SELECT 'test', t.row_id, round(f2.te, 6) FROM kte t LEFT JOIN f2 ON t.grid_id = f2.grid_id""")
def h3_kfold_encode_v2(spark, sf):
    """10 folds, s=100; unseen test cells stay null for a later fallback."""
    tr, te = keyed_split(spark, sf)
    tr = tr.withColumn("fold10", fx.fold_of("row_id", 10))
    a, b, _ = encode.encode_train_test(tr, te, "grid_id", _Y, "fold10", 100.0, "grid_te", unseen="null")
    return a.select(F.lit("train").alias("split"), "row_id", r6("grid_te")) \
        .unionByName(b.select(F.lit("test").alias("split"), "row_id", r6("grid_te")))


_H4 = (S.kfold_extra(10, "fold10")
       + ", k2tr AS (SELECT *, grid_id * 100 + CAST(month AS BIGINT) AS grid_month FROM kz_fold10 WHERE split = 'train')"
       + S.kfold_cte("ep", "ktr", "grid_period", 50) + S.kfold_cte("em", "k2tr", "grid_month", 200, fold="fold10"))


@query("h4_cross_encoding", sql=K + _H4 + """
SELECT g.row_id, round(ep.te, 6) AS grid_period_te, round(em.te, 6) AS grid_month_te FROM k2tr g
 JOIN ep ON g.grid_period = ep.grid_period AND g.fold = ep.fold JOIN em ON g.grid_month = em.grid_month AND g.fold10 = em.fold10""")
def h4_cross_encoding(spark, sf):
    """Cell x period (5 folds, s=50) and cell x month (10 folds, s=200) encodings."""
    tr, _ = keyed_split(spark, sf)
    tr = tr.withColumns({"fold10": fx.fold_of("row_id", 10), "grid_month": fx.cross_key("grid_id", "month", 100)})
    # the month's sums are taken from the rows, not from the encoded ones
    month = encode.stored_stats(tr, ["grid_month"], _Y, "fold10")
    out = encode.kfold_encode(tr, "grid_period", _Y, "fold", 50.0, "grid_period_te")
    out = encode.kfold_encode(out, "grid_month", _Y, "fold10", 200.0, "grid_month_te", stats=month)
    return out.select("row_id", r6("grid_period_te"), r6("grid_month_te"))


_SUB = "(SELECT * FROM ktr WHERE month <= 5)"
_MU5 = "(SELECT avg(invalid_ratio) FROM ktr WHERE month <= 5)"


@query("h5_subset_encoding", sql=K + S.full_enc_cte("c5", _SUB, "grid_id", 100, mu=_MU5)
       + S.full_enc_cte("p5", _SUB, "grid_period", 150, mu=_MU5) + f"""
SELECT t.row_id, round(coalesce(c5.te, CAST(CAST({_MU5} AS FLOAT) AS DOUBLE)), 6) AS grid_te,
 round(coalesce(p5.te, c5.te, CAST(CAST({_MU5} AS FLOAT) AS DOUBLE)), 6) AS grid_period_te
FROM kte t LEFT JOIN c5 ON t.grid_id = c5.grid_id LEFT JOIN p5 ON t.grid_period = p5.grid_period""")
def h5_subset_encoding(spark, sf):
    """Scoring encodings from months 1-5 only, own mean, chain fallback period -> cell -> mean."""
    tr, te = keyed_split(spark, sf)
    sub = tr.where("month <= 5")
    mu5 = encode.global_mean(sub, _Y)
    c5 = encode.fit_encoding(sub, "grid_id", _Y, 100.0, mu5)
    p5 = encode.fit_encoding(sub, "grid_period", _Y, 150.0, mu5)
    t = encode.apply_encoding(te, c5, "grid_id", "c_te")
    t = encode.apply_encoding(t, p5, "grid_period", "p_te")
    m = encode.as_stored(mu5)
    return t.select("row_id", r6(F.coalesce("c_te", m), "grid_te"), r6(F.coalesce("p_te", "c_te", m), "grid_period_te"))


_H6 = (", s5 AS (SELECT * FROM ktr WHERE month <= 5)" + S.kfold_cte("c6", "s5", "grid_id", 30, absent="null")
       + S.kfold_cte("p6", "s5", "grid_period", 50, absent="null"))
_CHAIN = [("grid_id", 30.0, "grid_te"), ("grid_period", 50.0, "grid_period_te")]


@query("h6_subset_kfold", sql=K + _H6 + f"""
SELECT g.row_id, round(coalesce(c6.te, {_mu_sql('s5')}), 6) AS grid_te, round(coalesce(p6.te, c6.te, {_mu_sql('s5')}), 6) AS grid_period_te
FROM s5 g LEFT JOIN c6 ON g.grid_id = c6.grid_id AND g.fold = c6.fold LEFT JOIN p6 ON g.grid_period = p6.grid_period AND g.fold = p6.fold""")
def h6_subset_kfold(spark, sf):
    """K-fold encodings inside the months 1-5 subset, period falling back to cell per fold."""
    tr, _ = keyed_split(spark, sf)
    out, _ = encode.chained_encodings(tr.where("month <= 5"), None, _CHAIN, _Y)
    return out.select("row_id", r6("grid_te"), r6("grid_period_te"))


# The same one level finer (cell x month x period x day), where many keys stand in a single fold only.
_FINE = "grid_period * 100 + CAST(month AS BIGINT)"
_H6F = (f", s5 AS (SELECT *, ({_FINE}) * 10 + CAST(dow AS BIGINT) AS fine FROM ktr WHERE month <= 5)" + S.kfold_cte("c6", "s5", "grid_id", 30, absent="null")
        + S.kfold_cte("p6", "s5", "grid_period", 50, absent="null") + S.kfold_cte("f6", "s5", "fine", 50, absent="null"))


@query("h6_chained_kfold", sql=K + _H6F + f"""
SELECT g.row_id, round(coalesce(f6.te, p6.te, c6.te, {_mu_sql('s5')}), 6) AS fine_te, CAST(f6.te IS NULL AS INTEGER) AS lone
FROM s5 g LEFT JOIN c6 ON g.grid_id = c6.grid_id AND g.fold = c6.fold LEFT JOIN p6 ON g.grid_period = p6.grid_period AND g.fold = p6.fold
 LEFT JOIN f6 ON g.fine = f6.fine AND g.fold = f6.fold""")
def h6_chained_kfold(spark, sf):
    """Three levels: cell, period, day of the month's period; ``lone`` marks rows whose finest key no other fold has."""
    tr, _ = keyed_split(spark, sf)
    sub = tr.where("month <= 5").withColumn("fine", F.expr(f"({_FINE}) * 10 + CAST(dow AS BIGINT)"))
    out, _ = encode.chained_encodings(sub, None, [*_CHAIN, ("fine", 50.0, "fine_te")], _Y)
    lone = encode.kfold_table(sub, "fine", _Y, "fold", 50.0, absent="null").select("fine", "fold", F.col("te").isNull().cast("int").alias("lone"))
    return out.join(lone, on=["fine", "fold"]).select("row_id", r6("fine_te"), "lone")


@query("h7_apply_encodings", sql=K + S.kfold_cte("ec", "ktr", "grid_id", 30) + S.kfold_cte("ep", "ktr", "grid_period", 50)
       + S.full_enc_cte("fc", "ktr", "grid_id", 30) + S.full_enc_cte("fp", "ktr", "grid_period", 50) + f"""
SELECT 'train' AS split, g.row_id, round(ec.te, 6) AS grid_te, round(ep.te, 6) AS grid_period_te FROM ktr g
 JOIN ec ON g.grid_id = ec.grid_id AND g.fold = ec.fold JOIN ep ON g.grid_period = ep.grid_period AND g.fold = ep.fold
UNION ALL SELECT 'test', t.row_id, round(coalesce(fc.te, {_mu_sql()}), 6), round(coalesce(fp.te, {_mu_sql()}), 6)
FROM kte t LEFT JOIN fc ON t.grid_id = fc.grid_id LEFT JOIN fp ON t.grid_period = fp.grid_period""")
def h7_apply_encodings(spark, sf):
    """Both encodings injected into the train (OOF) and scoring (full-train) frames."""
    tr, te = keyed_split(spark, sf)
    ftr, fte = pipeline.encodings(tr, te)
    return ftr.select(F.lit("train").alias("split"), "row_id", r6("grid_te"), r6("grid_period_te")) \
        .unionByName(fte.select(F.lit("test").alias("split"), "row_id", r6("grid_te"), r6("grid_period_te")))


@query("h8_encoding_report", sql=K + S.full_enc_cte("f2", "ktr", "grid_id", 100) + """
, t AS (SELECT f2.te FROM kte LEFT JOIN f2 ON kte.grid_id = f2.grid_id)
SELECT count(*) AS rows, CAST(sum(CASE WHEN te IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unseen_rows, round(avg(te), 6) AS mean,
 round(stddev_samp(te), 6) AS std, round(min(te), 6) AS min, round(max(te), 6) AS max,
 round(100e0 * sum(CASE WHEN te IS NULL THEN 1 ELSE 0 END) / count(*), 6) AS unseen_pct, (SELECT count(*) FROM f2) AS categories FROM t""")
def h8_encoding_report(spark, sf):
    tr, te = keyed_split(spark, sf)
    enc = encode.fit_encoding(tr, "grid_id", _Y, 100.0)
    t = encode.apply_encoding(te, enc, "grid_id", "te")
    rep = encode.encoding_report(t, "te", enc)
    return rep.select("rows", "unseen_rows", r6("mean"), r6("std"), r6("min"), r6("max"), r6("unseen_pct"), "categories")
