"""Registered rank, order and top-k queries (F1-F8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ranks, stats
from ..sources.fixtures import zone_obs
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)


@query("f1_average_rank", sql=""", tr AS (SELECT * FROM zone_obs WHERE split = 'train'), """ + S.rank_cte("ry", "tr", "invalid_ratio") + """
SELECT tr.row_id, round(ry.r / (SELECT count(*) FROM tr), 6) AS y_rank FROM tr JOIN ry ON tr.invalid_ratio = ry.invalid_ratio""")
def f1_average_rank(spark, sf):
    """Rank target: average rank of the ratio divided by N."""
    tr = zone_obs(spark, sf).where("split = 'train'")
    r = ranks.average_rank(tr, _Y, out="y_rank", normalise=True)
    return r.select("row_id", r6("y_rank"))


@query("f2_rank_in_sample", sql=""", tr AS (SELECT * FROM zone_obs WHERE split = 'train' AND month <= 5), """
       + S.rank_cte("rp", "tr", "pred_b", ["month"]) + """
SELECT tr.row_id, rp.r AS pred_rank FROM tr JOIN rp ON tr.month = rp.month AND tr.pred_b = rp.pred_b""")
def f2_rank_in_sample(spark, sf):
    """Average rank recomputed inside a filtered sample, per month."""
    tr = zone_obs(spark, sf).where("split = 'train' AND month <= 5")
    return ranks.average_rank(tr, "pred_b", by=["month"], out="pred_rank").select("row_id", "pred_rank")


_F3_SQL = """
, tr AS (SELECT invalid_ratio y FROM zone_obs WHERE split = 'train')
, m AS (SELECT count(*) m FROM tr)
, iv AS (SELECT y, sum(n) OVER (ORDER BY y ROWS UNBOUNDED PRECEDING) hi, sum(n) OVER (ORDER BY y ROWS UNBOUNDED PRECEDING) - n lo
  FROM (SELECT y, count(*) n FROM tr GROUP BY y) t)
, te AS (SELECT pred_a p, count(*) n FROM zone_obs WHERE split = 'test' GROUP BY pred_a)
, q AS (SELECT p, n, (sum(n) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2e0) / sum(n) OVER () * (SELECT m - 1 FROM m) h FROM te)
, mp AS (SELECT q.p, a.y + (b.y - a.y) * (q.h - floor(q.h)) AS mapped FROM q JOIN iv a ON floor(q.h) >= a.lo AND floor(q.h) < a.hi
  JOIN iv b ON ceil(q.h) >= b.lo AND ceil(q.h) < b.hi)
"""


@query("f3_rank_normalise", sql=_F3_SQL + """
SELECT z.row_id, round(mp.mapped, 6) AS mapped FROM zone_obs z JOIN mp ON z.pred_a = mp.p WHERE z.split = 'test'""")
def f3_rank_normalise(spark, sf):
    z = zone_obs(spark, sf)
    tr, te = z.where("split = 'train'"), z.where("split = 'test'")
    return ranks.rank_normalise(te, "pred_a", tr, _Y).select("row_id", r6("mapped"))


_F4_C, _F4_R = S.spearman_sql("(SELECT z.pred_a, mp.mapped FROM zone_obs z JOIN mp ON z.pred_a = mp.p WHERE z.split = 'test')",
                              "pred_a", "mapped", [], "s")


@query("f4_order_preserved", sql=_F3_SQL + _F4_C + f"""
SELECT round({_F4_R}, 6) AS rho, CASE WHEN {_F4_R} > 0.999999 THEN 'PASS' ELSE 'FAIL' END AS status FROM s_j""")
def f4_order_preserved(spark, sf):
    z = zone_obs(spark, sf)
    tr, te = z.where("split = 'train'"), z.where("split = 'test'")
    m = ranks.rank_normalise(te, "pred_a", tr, _Y)
    s = stats.spearman(m, "pred_a", "mapped")
    return s.select(r6("rho"), F.when(F.col("rho") > 0.999999, "PASS").otherwise("FAIL").alias("status"))


_CORR_FEATS = ["total_count", "precip", "temp", "wind", "hour", "dow", "month", "pred_a", "pred_b"]


def _feat_rho_sql(feats, src="(SELECT * FROM zone_obs WHERE split = 'train')"):
    parts, sels = "", []
    for i, f in enumerate(feats):
        c, r = S.spearman_sql(src, f, "invalid_ratio", [], f"s{i}")
        parts += c
        sels.append(f"SELECT '{f}' AS feature, (SELECT {r} FROM s{i}_j) AS rho")
    return parts + ", fr AS (" + " UNION ALL ".join(sels) + ")"


@query("f5_order_by_abs", sql=_feat_rho_sql(_CORR_FEATS) + """
SELECT feature, round(rho, 6) AS rho, CAST(row_number() OVER (ORDER BY abs(round(rho, 6)) DESC, feature) AS INTEGER) AS abs_rank FROM fr""")
def f5_order_by_abs(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    fr = stats.spearman_pairs(tr, [(f, _Y) for f in _CORR_FEATS]).select(F.col("a").alias("feature"), r6("rho"))
    w = Window.orderBy(F.abs("rho").desc(), "feature")  # one row per feature: bounded
    return fr.select("feature", "rho", F.row_number().over(w).cast("int").alias("abs_rank"))


@query("f6_top_n", sql="""
SELECT row_id, round(pred_a, 6) AS pred_a FROM zone_obs WHERE split = 'test' ORDER BY pred_a DESC, row_id LIMIT 15""")
def f6_top_n(spark, sf):
    te = zone_obs(spark, sf).where("split = 'test'")
    return te.orderBy(F.col("pred_a").desc(), "row_id").limit(15).select("row_id", r6("pred_a"))


@query("f7_arg_max", sql="""
, g AS (SELECT month, avg(pred_b) AS m FROM zone_obs WHERE split = 'train' GROUP BY month)
SELECT (SELECT month FROM g ORDER BY m DESC, month LIMIT 1) AS best_month, round((SELECT max(m) FROM g), 6) AS best_value""")
def f7_arg_max(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    g = tr.groupBy("month").agg(F.avg("pred_b").alias("m"))
    return g.agg(F.max_by("month", F.struct(F.col("m"), -F.col("month"))).alias("best_month"), r6(F.max("m"), "best_value"))


@query("f8_thin", sql="""
SELECT row_id, round(pred_b, 6) AS pred_b FROM (SELECT row_id, pred_b, row_number() OVER (ORDER BY row_id) AS rn FROM zone_obs WHERE split = 'train') t
WHERE (rn - 1) % 50 = 0""")
def f8_thin(spark, sf):
    """Every 50th row in row-id order (positions 1, 51, ...), from a distributed running count."""
    tr = zone_obs(spark, sf).where("split = 'train'")
    p = ranks.row_position(tr.select("row_id", "pred_b"), ["row_id"], out="pos")
    return p.where((F.col("pos") - 1) % 50 == 0).select("row_id", r6("pred_b"))
