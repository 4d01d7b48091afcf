"""Registered ensemble queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import ensemble as E
from ..sources import io
from ..sources.fixtures import zone_obs
from ..session import scratch_path, stored
from . import pipeline
from . import sqltext as S
from .common import keyed_split
from .registry import query, r6

_Y = "invalid_ratio"
K = S.keyed_cte(5)
_ENC = S.kfold_cte("e", "ktr", "grid_id", 30) + S.kfold_cte("ep", "ktr", "grid_period", 50) + \
    ", enc AS (SELECT g.*, e.te AS grid_te, ep.te AS grid_period_te FROM ktr g JOIN e ON g.grid_id = e.grid_id AND g.fold = e.fold " \
    "JOIN ep ON g.grid_period = ep.grid_period AND g.fold = ep.fold)"


def curve_sql(src: str, models, steps: int = 20, by: str | None = None, tag: str = "c") -> str:
    """CTEs ending in ``{tag}(by?, point, rho, n)`` for every grid point."""
    pts = E.simplex_grid(len(models), steps)
    vals = ", ".join("(" + ", ".join(str(v) for v in (i, *p)) + ")" for i, p in enumerate(pts))
    wcols = ", ".join(f"i{j}" for j in range(len(models)))
    blend = " + ".join(f"CAST(w.i{j} AS DOUBLE) * z.{m}" for j, m in enumerate(models))
    bsel = f"z.{by}, " if by else ""
    bl = f"{by}, " if by else ""
    part = f"PARTITION BY {by}, point" if by else "PARTITION BY point"
    nn = " AND ".join(f"z.{m} IS NOT NULL" for m in models)
    jb = f"b.{by} = ry.{by} AND " if by else ""
    jp = f"b.{by} = rp.{by} AND " if by else ""
    return f"""
, {tag}_w AS (SELECT * FROM (VALUES {vals}) AS t(point, {wcols}))
, {tag}_b AS (SELECT {bsel}w.point, z.{_Y} AS y, ({blend}) / {steps}e0 AS p FROM {src} z CROSS JOIN {tag}_w w
  WHERE z.{_Y} IS NOT NULL AND {nn})
, {tag}_ry AS (SELECT {bl}point, y, sum(n) OVER ({part} ORDER BY y ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2e0 AS r
  FROM (SELECT {bl}point, y, count(*) n FROM {tag}_b GROUP BY {bl}point, y) t)
, {tag}_rp AS (SELECT {bl}point, p, sum(n) OVER ({part} ORDER BY p ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2e0 AS r
  FROM (SELECT {bl}point, p, count(*) n FROM {tag}_b GROUP BY {bl}point, p) t)
, {tag} AS (SELECT {'b.' + by + ', ' if by else ''}b.point, {S.corr_sql('ry.r', 'rp.r')} AS rho, count(*) AS n FROM {tag}_b b
  JOIN {tag}_ry ry ON {jb}b.point = ry.point AND b.y = ry.y JOIN {tag}_rp rp ON {jp}b.point = rp.point AND b.p = rp.p
  GROUP BY {'b.' + by + ', ' if by else ''}b.point)
"""


def _best_sql(tag: str, models, steps: int = 20, where: str = "") -> str:
    pts = E.simplex_grid(len(models), steps)
    wsel = ", ".join(f"round(w.i{j} / {steps}e0, 6) AS w_{m}" for j, m in enumerate(models))
    return (f"SELECT c.point, round(c.rho, 6) AS rho, {wsel} FROM {tag} c JOIN {tag}_w w ON c.point = w.point {where}"
            f" ORDER BY c.rho DESC, c.point LIMIT 1")


def _sel(models):
    return [r6(f"w_{m}") for m in models]


_M2 = ["pred_a", "pred_b"]
_M3 = ["pred_a", "pred_b", "grid_te"]
_M4 = ["pred_a", "pred_b", "grid_te", "grid_period_te"]
_TR = "(SELECT * FROM zone_obs WHERE split = 'train')"


def _enc_train(spark, sf):
    tr, te = keyed_split(spark, sf)
    return pipeline.encodings(tr, te)[0]


@query("l1_blend_search", sql=curve_sql(_TR, _M2) + _best_sql("c", _M2))
def l1_blend_search(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    b = E.blend_search(tr, _M2, _Y, 20)
    return b.select("point", r6("rho"), *_sel(_M2))


@query("l2_blend_search3", sql=K + _ENC + curve_sql("enc", _M3) + _best_sql("c", _M3))
def l2_blend_search3(spark, sf):
    b = E.blend_search(_enc_train(spark, sf), _M3, _Y, 20)
    return b.select("point", r6("rho"), *_sel(_M3))


@query("l3_blend_search4")
def l3_blend_search4(spark, sf):
    """Four-model simplex search on the 0.05 grid (1,771 points), in batches of points.

    Points x rows is too large for the SQL oracle on whole tables; the search is
    tested against a brute-force numpy search on the small fixture instead
    (tests/test_invariants.py::test_four_model_search_matches_brute_force).
    """
    b = E.blend_search(_enc_train(spark, sf), _M4, _Y, 20)
    return b.select("point", r6("rho"), *_sel(_M4))


@query("l3_blend_search4_coarse", sql=K + _ENC + curve_sql("enc", _M4, 5) + _best_sql("c", _M4, 5))
def l3_blend_search4_coarse(spark, sf):
    """The same search on the 0.2 grid (56 points), small enough for the SQL oracle."""
    b = E.blend_search(_enc_train(spark, sf), _M4, _Y, 5)
    return b.select("point", r6("rho"), *_sel(_M4))


@query("l4_blend_search_subset", sql=curve_sql(_TR, _M2, by="sub", tag="c").replace(
    f"FROM {_TR} z", f"FROM (SELECT *, CASE WHEN month <= 5 THEN 'm1_5' ELSE 'other' END AS sub FROM zone_obs WHERE split = 'train' "
    "UNION ALL SELECT *, 'all' FROM zone_obs WHERE split = 'train') z") + """
, best AS (SELECT point FROM c WHERE sub = 'm1_5' ORDER BY rho DESC, point LIMIT 1)
SELECT c.point, round(s.rho, 6) AS rho_subset, round(c.rho, 6) AS rho_all, round(w.i0 / 20e0, 6) AS w_pred_a
FROM c JOIN best ON c.point = best.point JOIN c s ON s.point = c.point AND s.sub = 'm1_5' JOIN c_w w ON w.point = c.point WHERE c.sub = 'all'""")
def l4_blend_search_subset(spark, sf):
    """Weights tuned on months 1-5; all rows are ranked at the best point alone."""
    tr = zone_obs(spark, sf).where("split = 'train'").select(*_M2, _Y, "month")
    best = stored(E.blend_search(tr, _M2, _Y, 20, where=F.col("month") <= 5).select("point", F.col("rho").alias("rho_subset"), "w_pred_a"), "best")  # one row
    allr = E.blend_curve(tr, _M2, _Y, 20, only=[r[0] for r in best.select("point").collect()] or [0]).select("point", F.col("rho").alias("rho_all"))
    return best.join(allr, on="point").select("point", r6("rho_subset"), r6("rho_all"), r6("w_pred_a"))


@query("l5_blend_curve", sql=curve_sql(_TR, _M2) + """
SELECT c.point, round(c.rho, 6) AS rho, c.n, round(w.i0 / 20e0, 6) AS w_pred_a, round(w.i1 / 20e0, 6) AS w_pred_b FROM c JOIN c_w w ON c.point = w.point""")
def l5_blend_curve(spark, sf):
    tr = zone_obs(spark, sf).where("split = 'train'")
    c = E.blend_curve(tr, _M2, _Y, 20)
    return c.select("point", r6("rho"), "n", *_sel(_M2))


@query("l6_choose_strategy", sql=K + _ENC + curve_sql("enc", _M2, tag="c2") + curve_sql("enc", _M3, tag="c3") + """
, s AS (SELECT 'blend2' AS strategy, max(rho) AS rho FROM c2 UNION ALL SELECT 'blend3', max(rho) FROM c3)
SELECT strategy, round(rho, 6) AS rho, CASE WHEN strategy = (CASE WHEN (SELECT rho FROM s WHERE strategy = 'blend3') >=
 (SELECT rho FROM s WHERE strategy = 'blend2') + 0.001 THEN 'blend3' ELSE 'blend2' END) THEN 1 ELSE 0 END AS chosen FROM s""")
def l6_choose_strategy(spark, sf):
    """A third model joins only when it adds at least 0.001 rho; else keep the two-model blend."""
    d = _enc_train(spark, sf)
    b2 = E.blend_search(d, _M2, _Y, 20).select("rho").withColumn("strategy", F.lit("blend2"))
    b3 = E.blend_search(d, _M3, _Y, 20).select("rho").withColumn("strategy", F.lit("blend3"))
    s = b2.unionByName(b3)
    r2, r3 = b2.select("rho").scalar(), b3.select("rho").scalar()
    pick = F.when(r3 >= r2 + F.lit(0.001), F.lit("blend3")).otherwise(F.lit("blend2"))
    return s.select("strategy", r6("rho"), (F.col("strategy") == pick).cast("int").alias("chosen"))


_L6_FIRST, _L6_LAYERS = ("pred_a", "pred_b"), {"layer1": ("grid_te", "pred_b"), "layer2": ("grid_period_te", "pred_a")}


def _l6_sql(threshold: float) -> str:
    """Curves of the three pairs, of the second search over their best blends, and the ordered choice."""
    pairs = {"first": _L6_FIRST, **_L6_LAYERS}
    long = " UNION ALL ".join(f"SELECT '{s}{sub}' AS k, {a} AS a, {b} AS b, {_Y}, month FROM enc{where}" for s, (a, b) in pairs.items()
                              for sub, where in (("", ""), (":sub", " WHERE month <= 5")))
    curve = curve_sql("lg", ["a", "b"], by="k", tag="c")
    second = curve_sql("lb", ["a", "b"], by="k", tag="d")
    weight = lambda k: f"(SELECT w.i0 FROM top JOIN c_w w ON w.point = top.point WHERE k = {k})"
    blend = lambda k, x, y: f"(CAST({weight(k)} AS DOUBLE) * {x} + CAST(20 - {weight(k)} AS DOUBLE) * {y}) / 20e0"
    layer = (f"CASE WHEN (SELECT k FROM lead) = 'layer1' THEN {blend(chr(39) + 'layer1' + chr(39), 'grid_te', 'pred_b')} "
             f"ELSE {blend(chr(39) + 'layer2' + chr(39), 'grid_period_te', 'pred_a')} END")
    return K + _ENC + f", lg AS ({long})" + curve + f"""
, top AS (SELECT k, arg_max(point, (rho, -point)) AS point, max(rho) AS rho FROM c WHERE k NOT LIKE '%:sub' GROUP BY k)
, lead AS (SELECT k, rho, rho >= {threshold} AS good FROM top WHERE k <> 'first' ORDER BY rho DESC, k LIMIT 1)
, bl AS (SELECT {blend("'first'", 'pred_a', 'pred_b')} AS a, {layer} AS b, {_Y}, month FROM enc WHERE (SELECT good FROM lead))
, lb AS (SELECT 'both' AS k, a, b, {_Y} FROM bl UNION ALL SELECT 'both:sub', a, b, {_Y} FROM bl WHERE month <= 5)""" + second + """
, two AS (SELECT k, arg_max(point, (rho, -point)) AS point, max(rho) AS rho FROM d WHERE k NOT LIKE '%:sub' GROUP BY k)
, t AS (SELECT top.k AS strategy, top.rho, s.rho AS rho_subset, w.i0 / 20e0 AS weight,
  CASE WHEN top.k <> 'first' THEN top.k = (SELECT k FROM lead) AND (SELECT good FROM lead) END AS qualified
  FROM top JOIN c_w w ON w.point = top.point LEFT JOIN c s ON s.k = top.k || ':sub' AND s.point = top.point
  UNION ALL SELECT two.k, two.rho, s.rho, w.i0 / 20e0, NULL FROM two JOIN d_w w ON w.point = two.point LEFT JOIN d s ON s.k = 'both:sub' AND s.point = two.point)
, pick AS (SELECT CASE WHEN (SELECT rho FROM t WHERE strategy = 'both') >= f.rho THEN 'both'
  WHEN (SELECT good FROM lead) AND (SELECT rho FROM lead) >= f.rho THEN (SELECT k FROM lead) ELSE 'first' END AS s FROM t f WHERE strategy = 'first')
SELECT strategy, round(rho, 6) AS rho, round(rho_subset, 6) AS rho_subset, round(weight, 6) AS weight, qualified, strategy = (SELECT s FROM pick) AS chosen FROM t"""


def _picked(spark, sf, threshold):
    t = E.final_pick(_enc_train(spark, sf), _L6_FIRST, _L6_LAYERS, _Y, F.col("month") <= 5, threshold)
    return t.select("strategy", r6("rho"), r6("rho_subset"), r6("weight"), "qualified", "chosen")


@query("l6_final_pick", sql=_l6_sql(0.2))
def l6_final_pick(spark, sf):
    """Best blend of two stored predictions, of each layer's pair, and of those blends; the layer qualifies."""
    return _picked(spark, sf, 0.2)


@query("l6_final_pick_unqualified", sql=_l6_sql(1.0))
def l6_final_pick_unqualified(spark, sf):
    """The same with a threshold that no layer reaches: no second search, the first blend stays."""
    return _picked(spark, sf, 1.0)


@query("l7_top_blends", sql=K + _ENC + curve_sql("(SELECT *, 'all' AS sub FROM enc UNION ALL SELECT *, 'tc1' FROM enc WHERE total_count = 1)",
                                                 _M3, by="sub", tag="c") + """
, top AS (SELECT point, rho FROM c WHERE sub = 'all' ORDER BY rho DESC, point LIMIT 5)
SELECT top.point, round(top.rho, 6) AS rho_all, round(s.rho, 6) AS rho_tc1,
 CAST(row_number() OVER (ORDER BY top.rho DESC, top.point) AS INTEGER) AS rank FROM top LEFT JOIN c s ON s.point = top.point AND s.sub = 'tc1'""")
def l7_top_blends(spark, sf):
    """Five best three-model blends with their score on the tc=1 segment."""
    from pyspark.sql import Window
    d = _enc_train(spark, sf)
    top = E.best_curve(d, _M3, _Y, 20, best=5).orderBy(F.col("rho").desc(), "point").limit(5).select("point", F.col("rho").alias("rho_all"))
    top = stored(top, "top_blends")  # five rows
    one = d.where("total_count = 1")
    seg = E.blend_curve(one, _M3, _Y, 20, only=[r[0] for r in top.select("point").collect()] or [0]).select("point", F.col("rho").alias("rho_tc1"))
    w = Window.orderBy(F.col("rho_all").desc(), "point")  # five rows
    return top.join(seg, on="point", how="left").select("point", r6("rho_all"), r6("rho_tc1"),
                                                        F.row_number().over(w).cast("int").alias("rank"))


@query("l8_final_predictions", sql=curve_sql(_TR, _M2) + """
, best AS (SELECT w.i0 / 20e0 AS wa FROM c JOIN c_w w ON c.point = w.point ORDER BY c.rho DESC, c.point LIMIT 1)
SELECT row_id, round(least(greatest((SELECT wa FROM best) * pred_a + (1e0 - (SELECT wa FROM best)) * pred_b, 0e0), 1e0), 6) AS invalid_ratio
FROM zone_obs WHERE split = 'test'""")
def l8_final_predictions(spark, sf):
    """Best two-model weights applied to the test rows, clipped, written as CSV and read back."""
    z = zone_obs(spark, sf)
    best = E.blend_search(z.where("split = 'train'"), _M2, _Y, 20)
    wa = best.select("w_pred_a").scalar()
    pred = z.where("split = 'test'").select("row_id", (wa * F.col("pred_a") + (F.lit(1.0) - wa) * F.col("pred_b")).alias("pred"))
    sub = io.write_submission(pred, scratch_path(spark, "submission"))
    return sub.select("row_id", r6("invalid_ratio"))
