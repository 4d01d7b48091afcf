"""Registered statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode, lookup, stats
from ..sources.fixtures import zone_obs
from . import sqltext as S
from .common import keyed, keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_ENC5 = S.kfold_cte("e", "ktr", "grid_id", 30) + \
    ", enc AS (SELECT g.*, e.te AS grid_te FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold)"


def _oof(spark, sf):
    tr, te = keyed_split(spark, sf)
    return encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "grid_te"), te


_G1_C, _G1_R = S.spearman_sql("enc", "grid_te", "invalid_ratio", [], "s")


@query("g1_spearman", sql=K + _ENC5 + _G1_C + f"\nSELECT round({_G1_R}, 6) AS rho, count(*) AS n FROM s_j")
def g1_spearman(spark, sf):
    enc, _ = _oof(spark, sf)
    return stats.spearman(enc, "grid_te", _Y, with_n=True).select(r6("rho"), "n")


_MAT = ["total_count", "precip", "temp", "wind", "hour", "dow", "month", _Y]
_PAIRS = [(a, b) for i, a in enumerate(_MAT) for b in _MAT[i + 1:]]


def _pairs_sql(pairs, src):
    """(CTE text, UNION of one row per pair) for pairwise Spearman."""
    ctes, sels = "", []
    for i, (a, b) in enumerate(pairs):
        c, r = S.spearman_sql(src, a, b, [], f"p{i}")
        ctes += c
        sels.append(f"SELECT '{a}' AS a, '{b}' AS b, (SELECT round({r}, 6) FROM p{i}_j) AS rho")
    return ctes, " UNION ALL ".join(sels)


_G2_C, _G2_U = _pairs_sql(_PAIRS, "tr")


@query("g2_spearman_matrix", sql=", tr AS (SELECT * FROM zone_obs WHERE split = 'train')" + _G2_C + "\n" + _G2_U)
def g2_spearman_matrix(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    return stats.spearman_pairs(tr, _PAIRS).select("a", "b", r6("rho"))


_G3_FEATS = ["total_count", "precip", "temp", "wind", "hour", "dow", "month", "grid_te"]


def _g3_sql():
    ctes, sels = "", []
    for i, f in enumerate(_G3_FEATS):
        c, r = S.spearman_sql("enc", f, "invalid_ratio", [], f"q{i}")
        ctes += c
        sels.append(f"SELECT '{f}' AS feature, (SELECT round({r}, 6) FROM q{i}_j) AS rho")
    return ctes + ", fr AS (" + " UNION ALL ".join(sels) + ")"


@query("g3_feature_correlations", sql=K + _ENC5 + _g3_sql() + """
SELECT feature, rho, CASE WHEN abs(rho) > 0.3 THEN '***' WHEN abs(rho) > 0.1 THEN '**' ELSE '' END AS marker,
 CAST(row_number() OVER (ORDER BY abs(rho) DESC, feature) AS INTEGER) AS abs_rank FROM fr""")
def g3_feature_correlations(spark, sf):
    from pyspark.sql import Window
    enc, _ = _oof(spark, sf)
    fr = stats.spearman_pairs(enc, [(f, _Y) for f in _G3_FEATS]).select(F.col("a").alias("feature"), r6("rho"))
    w = Window.orderBy(F.abs("rho").desc(), "feature")  # one row per feature: bounded
    return fr.select("feature", "rho", fx.stars("rho").alias("marker"),
                     F.row_number().over(w).cast("int").alias("abs_rank"))


_SUBSETS = {"all": "TRUE", "tc1": "total_count = 1", "tc_gt1": "total_count > 1", "tc_ge5": "total_count >= 5",
            "tc_ge10": "total_count >= 10", "month_1_5": "month <= 5"}
_G5_C, _G5_R = S.spearman_sql("sub", "pred_b", "invalid_ratio", ["subset"], "s")


@query("g5_spearman_subsets", sql=", sub AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS subset, pred_b, invalid_ratio FROM zone_obs WHERE split = 'train' AND {v}" for k, v in _SUBSETS.items())
    + ")" + _G5_C + f"\nSELECT subset, count(*) AS n, round({_G5_R}, 6) AS rho FROM s_j GROUP BY subset")
def g5_spearman_subsets(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    tags = F.array(*[F.when(F.expr(v), F.lit(k)) for k, v in _SUBSETS.items()])
    ex = tr.select("pred_b", _Y, F.explode(tags).alias("subset")).where(F.col("subset").isNotNull())
    return stats.spearman(ex, "pred_b", _Y, by=["subset"], with_n=True).select("subset", "n", r6("rho"))


@query("g6_pearson", sql=f"""
SELECT split, round({S.corr_sql('pred_a', 'pred_b')}, 6) AS r FROM zone_obs GROUP BY split""")
def g6_pearson(spark, sf):
    return stats.pearson(zone_obs(spark, sf), "pred_a", "pred_b", by=["split"]).select("split", r6("r"))


_MODELS = ["pred_a", "pred_b", "grid_te"]
_MPAIRS = [(a, b) for i, a in enumerate(_MODELS) for b in _MODELS[i + 1:]]


_G7_C, _G7_U = _pairs_sql(_MPAIRS, "enc")


@query("g7_diversity", sql=K + _ENC5 + _G7_C + ", mm AS (" + _G7_U + """)
SELECT a, b, rho, CASE WHEN rho < 0.95 THEN 'DIVERSE' ELSE 'REDUNDANT' END AS verdict FROM mm""")
def g7_diversity(spark, sf):
    enc, _ = _oof(spark, sf)
    m = stats.spearman_pairs(enc, _MPAIRS).select("a", "b", r6("rho"))
    return m.withColumn("verdict", F.when(F.col("rho") < 0.95, "DIVERSE").otherwise("REDUNDANT"))


@query("g8_ks_two_sample", sql=S.ks_sql("k", "(SELECT pred_b AS x, split AS s FROM zone_obs)") + """
SELECT round(ks, 6) AS ks FROM k""")
def g8_ks_two_sample(spark, sf):
    z = zone_obs(spark, sf)
    return stats.ks_two_sample(z, "pred_b", "split").select(r6("ks"))


@query("g9_ks_pvalue", sql=S.ks_sql("k", "(SELECT pred_b AS x, split AS s FROM zone_obs)") + """
, lam AS (SELECT ks, na, nb, ks * sqrt(CAST(na AS DOUBLE) * nb / (na + nb)) AS l FROM k)
SELECT round(ks, 6) AS ks, CAST(na AS BIGINT) AS n_train, CAST(nb AS BIGINT) AS n_test,
 round(CASE WHEN l <= 0 THEN 1e0
  WHEN l < 1 THEN 1e0 - sqrt(2e0 * pi()) / l * (SELECT sum(exp(-(2e0 * i - 1) * (2e0 * i - 1) * pi() * pi() / (8e0 * l * l))) FROM range(1, 101) r(i))
  ELSE 2e0 * (SELECT sum(pow(-1e0, i - 1) * exp(-2e0 * i * i * l * l)) FROM range(1, 101) r(i)) END, 6) AS p_value FROM lam""")
def g9_ks_pvalue(spark, sf):
    z = zone_obs(spark, sf)
    ks = stats.ks_two_sample(z, "pred_b", "split")
    n = z.groupBy().agg(F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("long").alias("n_train"),
                        F.sum(F.when(F.col("split") == "test", 1).otherwise(0)).cast("long").alias("n_test"))
    out = ks.withColumns({"n_train": n.select("n_train").scalar(), "n_test": n.select("n_test").scalar()})
    p = stats.ks_pvalue_expr(F.col("ks"), F.col("n_train").cast("double"), F.col("n_test").cast("double"))
    out = out.withColumn("p_value", p)
    return out.select(r6("ks"), "n_train", "n_test", r6("p_value"))


_G9_KEYS = ["grid_id", "month", "dow", "time_period"]
_G9_BY = ", ".join(_G9_KEYS)


# The oracle lists every order of both samples (bit masks of up to 14 values) and counts those with as large a gap.
@query("g9_ks_exact", sql=K + f"""
, v AS (SELECT {_G9_BY}, pred_b AS x, count(*) FILTER (WHERE split = 'train') a, count(*) FILTER (WHERE split = 'test') b FROM kz GROUP BY ALL)
, c AS (SELECT *, sum(a) OVER w ca, sum(b) OVER w cb, sum(a) OVER g n, sum(b) OVER g m FROM v
  WINDOW w AS (PARTITION BY {_G9_BY} ORDER BY x), g AS (PARTITION BY {_G9_BY}))
, k AS (SELECT {_G9_BY}, CAST(n AS BIGINT) n, CAST(m AS BIGINT) m, CAST(max(abs(ca * m - cb * n)) AS BIGINT) h,
  max(abs(CAST(ca AS DOUBLE) / n - CAST(cb AS DOUBLE) / m)) ks FROM c WHERE n > 0 AND m > 0 GROUP BY ALL)
, orders AS (SELECT n, m, CAST(o AS BIGINT) o FROM (SELECT DISTINCT n, m FROM k WHERE n + m <= 14) t, range(0, 16384) r(o)
  WHERE o < (1 << (n + m)) AND bit_count(CAST(o AS BIGINT)) = n)
, d AS (SELECT n, m, o, max(abs(bit_count(o & ((1::BIGINT << i) - 1)) * m - (i - bit_count(o & ((1::BIGINT << i) - 1))) * n)) h
  FROM orders, range(1, 15) t(i) WHERE i <= n + m GROUP BY n, m, o)
, e AS (SELECT t.n, t.m, t.h, avg(CASE WHEN d.h >= t.h THEN 1e0 ELSE 0e0 END) p FROM (SELECT DISTINCT n, m, h FROM k) t
  JOIN d ON d.n = t.n AND d.m = t.m GROUP BY ALL)
SELECT {', '.join('k.' + x for x in _G9_KEYS)}, round(k.ks, 6) ks, k.n n_first, k.m n_second, round(e.p, 6) p_value
FROM k LEFT JOIN e ON e.n = k.n AND e.m = k.m AND e.h = k.h""")
def g9_ks_exact(spark, sf):
    """KS test of train and test within every cell, month, weekday and period: small samples get the exact p-value."""
    t = stats.ks_test(keyed(spark, sf), "pred_b", "split", by=_G9_KEYS)
    return t.select(*_G9_KEYS, r6("ks"), "n_first", "n_second", r6("p_value"))


_G4_CTES, _G4_RHO = S.spearman_sql("enc", "grid_te", "invalid_ratio", ["count_bin"], "s")


@query("g4_spearman_by", sql=S.keyed_cte(5) + S.kfold_cte("e", "ktr", "grid_id", 30)
       + ", enc AS (SELECT g.count_bin, g.invalid_ratio, e.te AS grid_te FROM ktr g JOIN e "
         "ON g.grid_id = e.grid_id AND g.fold = e.fold)" + _G4_CTES + """
SELECT count_bin, count(*) AS n, round(100e0 * count(*) / (SELECT count(*) FROM ktr), 6) AS pct,
 round(""" + _G4_RHO + """, 6) AS rho FROM s_j GROUP BY count_bin""")
def g4_spearman_by(spark, sf):
    """Flagship: does the leakage-safe cell encoding rank the ratio, per count bin?"""
    tr, _ = keyed_split(spark, sf)
    enc = encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "grid_te")
    res = stats.spearman(enc, "grid_te", _Y, by=["count_bin"], with_n=True)
    total = tr.select(F.count(F.lit(1))).scalar()
    return res.select("count_bin", "n", r6(F.lit(100.0) * F.col("n") / total, "pct"), r6("rho"))


# ---- drift, gates and gaps -------------------------------------------------------------------

_V2 = (S.kfold_cte("e", "ktr", "grid_id", 30) + S.kfold_extra(10, "fold10") + ", k2tr AS (SELECT * FROM kz_fold10 WHERE split = 'train')"
       ", k2te AS (SELECT * FROM kz_fold10 WHERE split = 'test')"
       + S.kfold_cte("e2", "k2tr", "grid_id", 100, fold="fold10") + S.full_enc_cte("f2", "k2tr", "grid_id", 100)
       + S.full_enc_cte("f1", "ktr", "grid_id", 30) + """
, kc AS (SELECT DISTINCT grid_id, grid_lon, grid_lat FROM ktr)
, kn AS (SELECT kc.grid_lon AS gx, kc.grid_lat AS gy, f2.te FROM kc JOIN f2 ON kc.grid_id = f2.grid_id)
, un AS (SELECT DISTINCT grid_lon AS gx, grid_lat AS gy FROM kte WHERE grid_id NOT IN (SELECT grid_id FROM ktr))
, nn AS (SELECT ux, uy, te FROM (SELECT un.gx AS ux, un.gy AS uy, kn.te, row_number() OVER (PARTITION BY un.gx, un.gy
  ORDER BY (un.gx - kn.gx) * (un.gx - kn.gx) + (un.gy - kn.gy) * (un.gy - kn.gy), kn.gx * 100000 + kn.gy) AS rn FROM un CROSS JOIN kn) z WHERE rn = 1)
, old_d AS (SELECT e.te AS x, 'train' AS s FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold
  UNION ALL SELECT coalesce(f1.te, CAST(CAST((SELECT avg(invalid_ratio) FROM ktr) AS FLOAT) AS DOUBLE)), 'test' FROM kte t LEFT JOIN f1 ON t.grid_id = f1.grid_id)
, new_d AS (SELECT e2.te AS x, 'train' AS s FROM k2tr g JOIN e2 ON g.grid_id = e2.grid_id AND g.fold10 = e2.fold10
  UNION ALL SELECT coalesce(f2.te, nn.te), 'test' FROM kte t LEFT JOIN f2 ON t.grid_id = f2.grid_id LEFT JOIN nn ON t.grid_lon = nn.ux AND t.grid_lat = nn.uy)
""")


def _v1_v2(spark, sf):
    """Old (5 folds, s=30, unseen -> mu) and new (10 folds, s=100, nearest cell) cell encodings."""
    tr, te = keyed_split(spark, sf)
    tr = tr.withColumn("fold10", fx.fold_of("row_id", 10))
    mu = encode.global_mean(tr, _Y)
    old_tr = encode.kfold_encode(tr, "grid_id", _Y, "fold", 30.0, "x", mu)
    old_te = encode.apply_encoding(te, encode.fit_encoding(tr, "grid_id", _Y, 30.0, mu), "grid_id", "x",
                                   fill=encode.as_stored(mu))
    new_tr = encode.kfold_encode(tr, "grid_id", _Y, "fold10", 100.0, "x", mu)
    enc2 = encode.fit_encoding(tr, "grid_id", _Y, 100.0, mu)
    cells = tr.select("grid_id", "grid_lon", "grid_lat").distinct()
    new_te = lookup.fill_from_nearest(te, enc2, "grid_id", "x", cells=cells)
    old = old_tr.select("x", F.lit("train").alias("s")).unionByName(old_te.select("x", F.lit("test").alias("s")))
    new = new_tr.select("x", F.lit("train").alias("s")).unionByName(new_te.select("x", F.lit("test").alias("s")))
    return old, new


@query("g10_drift_report", sql=K + _V2 + S.ks_sql("ko", "old_d") + S.ks_sql("kn2", "new_d") + """
SELECT 'grid_te' AS feature, round(ko.ks, 6) AS old_ks, round(kn2.ks, 6) AS new_ks, round(kn2.ks - ko.ks, 6) AS change,
 CASE WHEN kn2.ks < 0.005 THEN 'PASS' ELSE 'CHECK' END AS status FROM ko, kn2""")
def g10_drift_report(spark, sf):
    old, new = _v1_v2(spark, sf)
    ko = stats.ks_two_sample(old, "x", "s").select("ks").scalar()
    kn = stats.ks_two_sample(new, "x", "s").select("ks").scalar()
    return spark.range(1).select(F.lit("grid_te").alias("feature"), r6(ko, "old_ks"), r6(kn, "new_ks"),
                                 r6(kn - ko, "change"),
                                 F.when(kn < F.lit(0.005), "PASS").otherwise("CHECK").alias("status"))


@query("g11_leakage_gate", sql=K + _ENC5 + _G1_C + f"""
SELECT round({_G1_R}, 6) AS rho, CASE WHEN {_G1_R} > 0.7 THEN 'LEAK' WHEN {_G1_R} < 0.1 THEN 'WEAK' ELSE 'PASS' END AS status FROM s_j""")
def g11_leakage_gate(spark, sf):
    enc, _ = _oof(spark, sf)
    s = stats.spearman(enc, "grid_te", _Y)
    return s.select(r6("rho"), stats.leakage_gate(F.col("rho")).alias("status"))


@query("g12_auc", sql="""
, z AS (SELECT pred_a p, CASE WHEN split = 'test' THEN 1 ELSE 0 END l FROM zone_obs)
, r AS (SELECT p, sum(n) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2e0 r FROM (SELECT p, count(*) n FROM z GROUP BY p) t)
SELECT round((sum(CASE WHEN l = 1 THEN r.r ELSE 0e0 END) - sum(l) * (sum(l) + 1) / 2e0) / (CAST(sum(l) AS DOUBLE) * sum(1 - l)), 6) AS auc
FROM z JOIN r ON z.p = r.p""")
def g12_auc(spark, sf):
    z = zone_obs(spark, sf).select(F.col("pred_a"), F.when(F.col("split") == "test", 1).otherwise(0).alias("l"))
    return stats.auc(z, "pred_a", "l").select(r6("auc"))


_G13_C, _G13_R = S.spearman_sql("gl", "p", "invalid_ratio", ["model", "split"], "s")


@query("g13_score_gap", sql=""", gl AS (SELECT 'pred_a' AS model, split, pred_a AS p, invalid_ratio FROM zone_obs
 UNION ALL SELECT 'pred_b', split, pred_b, invalid_ratio FROM zone_obs)""" + _G13_C + f"""
, sc AS (SELECT model, split, {_G13_R} AS rho FROM s_j GROUP BY model, split)
SELECT a.model, round(a.rho, 6) AS offline, round(b.rho, 6) AS online, round(a.rho - b.rho, 6) AS gap,
 round(avg(a.rho - b.rho) OVER (), 6) AS mean_gap FROM sc a JOIN sc b ON a.model = b.model AND a.split = 'train' AND b.split = 'test'""")
def g13_score_gap(spark, sf):
    """Offline (train) vs held-out (test) rank score per model, their gap and its mean over the models."""
    z = zone_obs(spark, sf)
    long = z.select("split", _Y, F.explode(F.array(
        F.struct(F.lit("pred_a").alias("model"), F.col("pred_a").alias("p")),
        F.struct(F.lit("pred_b").alias("model"), F.col("pred_b").alias("p")))).alias("m")).select("split", _Y, "m.*")
    sc = stats.spearman(long, "p", _Y, by=["model", "split"])
    a = sc.where("split = 'train'").select("model", F.col("rho").alias("offline"))
    b = sc.where("split = 'test'").select("model", F.col("rho").alias("online"))
    j = a.join(b, on="model")
    mean = j.select(F.avg(F.col("offline") - F.col("online"))).scalar()
    return j.select("model", r6("offline"), r6("online"), r6(F.col("offline") - F.col("online"), "gap"), r6(mean, "mean_gap"))


_G14_SQL = (S.kfold_extra(10, "fold10") + ", k2tr AS (SELECT *, grid_id * 100 + CAST(month AS BIGINT) AS grid_month FROM kz_fold10 WHERE split = 'train')"
            + S.kfold_cte("em", "k2tr", "grid_month", 200, fold="fold10") + S.kfold_cte("e", "ktr", "grid_id", 30)
            + """, cand AS (SELECT g.row_id, g.invalid_ratio, em.te AS grid_month_te FROM k2tr g JOIN em ON g.grid_month = em.grid_month AND g.fold10 = em.fold10)
, sib AS (SELECT g.row_id, e.te AS grid_te FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold)
, both_ AS (SELECT c.*, s.grid_te FROM cand c JOIN sib s ON c.row_id = s.row_id)""")
_G14_C, _G14_R = S.spearman_sql("both_", "grid_month_te", "invalid_ratio", [], "s")


@query("g14_feature_gate", sql=K + _G14_SQL + _G14_C + f"""
, v AS (SELECT (SELECT {_G14_R} FROM s_j) AS rho, (SELECT {S.corr_sql('grid_month_te', 'grid_te')} FROM both_) AS r)
SELECT round(rho, 6) AS rho, round(r, 6) AS corr_sibling, CASE WHEN rho > 0.25 AND r < 0.96 THEN 'PASS' ELSE 'REJECT' END AS status FROM v""")
def g14_feature_gate(spark, sf):
    """Candidate cell x month encoding kept only if it ranks (rho > 0.25) and is not a copy of grid_te."""
    tr, _ = keyed_split(spark, sf)
    tr = tr.withColumns({"fold10": fx.fold_of("row_id", 10), "grid_month": fx.cross_key("grid_id", "month", 100)})
    mu = encode.global_mean(tr, _Y)
    c = encode.kfold_encode(tr, "grid_month", _Y, "fold10", 200.0, "grid_month_te", mu)
    c = encode.kfold_encode(c, "grid_id", _Y, "fold", 30.0, "grid_te", mu)
    rho = stats.spearman(c, "grid_month_te", _Y).select("rho").scalar()
    r = stats.pearson(c, "grid_month_te", "grid_te").select("r").scalar()
    return spark.range(1).select(r6(rho, "rho"), r6(r, "corr_sibling"),
                                 F.when((rho > 0.25) & (r < 0.96), "PASS").otherwise("REJECT").alias("status"))


@query("g15_encoding_shift", sql=K + S.full_enc_cte("ef", "ktr", "grid_id", 30)
       + S.full_enc_cte("e5", "(SELECT * FROM ktr WHERE month <= 5)", "grid_id", 100,
                        mu="(SELECT avg(invalid_ratio) FROM ktr WHERE month <= 5)") + """
, two AS (SELECT t.row_id, coalesce(ef.te, CAST(CAST((SELECT avg(invalid_ratio) FROM ktr) AS FLOAT) AS DOUBLE)) AS full_te,
  coalesce(e5.te, CAST(CAST((SELECT avg(invalid_ratio) FROM ktr WHERE month <= 5) AS FLOAT) AS DOUBLE)) AS m5_te
  FROM kte t LEFT JOIN ef ON t.grid_id = ef.grid_id LEFT JOIN e5 ON t.grid_id = e5.grid_id)
""" + S.ks_sql("k", "(SELECT full_te AS x, 'train' AS s FROM two UNION ALL SELECT m5_te, 'test' FROM two)") + """
SELECT round(avg(full_te), 6) AS mean_full, round(stddev_samp(full_te), 6) AS std_full, round(avg(m5_te), 6) AS mean_m5,
 round(stddev_samp(m5_te), 6) AS std_m5, (SELECT round(ks, 6) FROM k) AS ks FROM two""")
def g15_encoding_shift(spark, sf):
    """Test frame encoded from all train rows vs from months 1-5 only: moments and KS."""
    tr, te = keyed_split(spark, sf)
    mu = encode.global_mean(tr, _Y)
    sub = tr.where("month <= 5")
    mu5 = encode.global_mean(sub, _Y)
    t = encode.apply_encoding(te, encode.fit_encoding(tr, "grid_id", _Y, 30.0, mu), "grid_id", "full_te",
                              fill=encode.as_stored(mu))
    t = encode.apply_encoding(t, encode.fit_encoding(sub, "grid_id", _Y, 100.0, mu5), "grid_id", "m5_te",
                              fill=encode.as_stored(mu5))
    both = t.select(F.col("full_te").alias("x"), F.lit("train").alias("s")) \
        .unionByName(t.select(F.col("m5_te").alias("x"), F.lit("test").alias("s")))
    ks = stats.ks_two_sample(both, "x", "s").select("ks").scalar()
    return t.agg(r6(F.avg("full_te"), "mean_full"), r6(F.stddev_samp("full_te"), "std_full"),
                 r6(F.avg("m5_te"), "mean_m5"), r6(F.stddev_samp("m5_te"), "std_m5")).withColumn("ks", r6(ks))
