"""Cases that only show at scale or at the edges: ties, constants, nulls, far cells, keys near 1e9, plans without pairings."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from zonekit.functions import features as fx
from zonekit.operators import checks, ensemble, hexbin, lookup, models as M, ranks, split, stats
from zonekit.plans import common, sqltext
from zonekit.sources import fixtures, io


def _p(spark, d, n, m):
    return spark.range(1).select(stats.ks_pvalue_expr(F.lit(float(d)), F.lit(float(n)), F.lit(float(m))).alias("p")).first()["p"]


def test_ks_pvalue_at_both_ends(spark):
    assert _p(spark, 0, 50, 50) == 1
    for lam in (0.005, 0.01, 0.2, 0.5, 0.99, 1.0, 1.01, 1.36, 2.5):
        series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 20_000))
        want = 1.0 if lam < 0.15 else series
        assert _p(spark, lam / math.sqrt(50_000), 100_000, 100_000) == pytest.approx(want, abs=1e-9)


def test_constant_column_has_no_rho(spark):
    d = spark.range(100_003).select(F.lit(0.3).alias("a"), (F.col("id") % 977).cast("double").alias("b"))
    assert stats.spearman(d, "a", "b").first()["rho"] is None
    assert stats.spearman(d, "b", "a").first()["rho"] is None
    assert stats.spearman_pairs(d, [("a", "b"), ("b", "b")]).orderBy("a").collect()[0]["rho"] is None
    assert all(r.rho is None for r in ensemble.blend_curve(d.withColumn("c", F.lit(0.1)), ["a", "c"], "b", 4).collect())


def test_null_groups_and_labels_stay(spark):
    d = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0), (3, "x", 5.0), (4, "x", 9.0)], "row_id long, label string, v double")
    assert split.assign_stratified_fold(d, "label", 2).count() == 4
    q = {r.label: r.value for r in ranks.exact_quantiles(d, "v", [0.5], ["label"]).collect()}
    assert q == {None: 2.0, "x": 7.0}
    r = {r.row_id: r["rank"] for r in ranks.average_rank(d, "v", ["label"], normalise=True).collect()}
    assert r == {1: 0.5, 2: 1.0, 3: 0.5, 4: 1.0}
    assert stats.spearman(d.withColumn("w", -F.col("v")), "v", "w", ["label"]).count() == 2


def test_cells_truncate(spark):
    d = spark.createDataFrame([(-1.00002,), (1.00002,), (-1e-6,)], "x double")
    assert [r[0] for r in d.select(fx.grid_axis("x")).collect()] == [int(x / 5e-5) for x in (-1.00002, 1.00002, -1e-6)] == [-20000, 20000, 0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_pair_nothing(spark, no_broadcast):
    d = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 4999).cast("double").alias("v"))
    for by in ([], ["g"]):
        q = ranks.exact_quantiles(d, "v", [0.0, 0.1, 0.5, 1.0], by)
        assert "Cartesian" not in _plan(q) and "NestedLoop" not in _plan(q)
        pdf = d.toPandas()
        for r in q.collect():
            own = pdf if not by else pdf[pdf.g == r.g]
            assert r.value == pytest.approx(np.quantile(own.v, r.q))


def test_pairs_hold_a_row_once(spark, monkeypatch):
    """Columns are ranked once, whatever the number of pairs; each pair has the rho of its complete rows, by group too."""
    r = np.random.default_rng(5)
    p = pd.DataFrame({c: np.where(r.random(400) < share, np.nan, r.integers(0, most, 400)) for c, share, most in (("a", 0, 6), ("b", 0.2, 300), ("c", 0.5, 9), ("d", 0, 400))})
    p["g"] = np.arange(400) % 3
    d = spark.createDataFrame(p).select("g", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abcd"], F.lit(None).cast("double").alias("e"))
    pairs, own, seen = [(x, y) for i, x in enumerate("abcde") for y in "abcde"[i:]], stats.stored, []
    monkeypatch.setattr(stats, "stored", lambda df, *a, **k: seen.append(df.count()) or own(df, *a, **k))
    for by in ([], ["g"]):
        found = stats.spearman_pairs(d, pairs, by).collect()
        assert len(found) == 10 * (3 if by else 1)
        for x in found:
            rows = (p[p.g == x.g] if by else p)[[x.a]].assign(other=p[x.b]).dropna()
            assert x.rho == pytest.approx(np.corrcoef(rows[x.a].rank(), rows["other"].rank())[0, 1])
    assert seen == [sum(p[c].nunique() for c in "abcd"), sum(p.groupby("g")[c].nunique().sum() for c in "abcd")]


def test_sample_orders_few_rows(spark, monkeypatch):
    """Only rows near the sample are put in order; the sample is that of ordering all, with repeated and null keys."""
    d = spark.range(40_000).select(F.when(F.col("id") % 1000 != 7, F.col("id") % 30_000).alias("row_id"), F.lit(1).alias("x"))
    want = sorted((r.h is not None, r.h or 0, r.row_id or 0) for r in d.select("row_id", fx.mix32("row_id", 3).alias("h")).collect())
    own, seen = ranks.row_position, []
    monkeypatch.setattr(split, "row_position", lambda df, *a, **k: seen.append(df.count()) or own(df, *a, **k))
    for n, most in ((0, 0), (100, 160), (10_000, 10_100), (50_000, 40_000)):
        got = [r.row_id for r in split.sample_n(d, n, seed=3).collect()]
        assert sorted(got, key=lambda k: (k is not None, k or 0)) == sorted(((k if known else None) for known, _, k in want[:n]), key=lambda k: (k is not None, k or 0))
        assert seen[-1] <= most
    assert split.sample_n(d, spark.range(500).select(F.count(F.lit(1))).scalar(), seed=3).count() == 500
    assert split.sample_n(d.where("x = 2"), 10).count() == 0


def test_hex_bin_scans_once(spark):
    z = fixtures.zone_obs(spark, SF_SMALL)
    assert _plan(hexbin.hex_bin(z, "lon", "lat", "invalid_ratio")).count("FileScan") <= 2
    assert hexbin.hex_bin(z.where("lon > 5"), "lon", "lat").collect() == []


def test_hex_bin_computes_a_row_once(spark):
    z = fixtures.zone_obs(spark, SF_SMALL)
    plan = _plan(hexbin.hex_bin(z, "pred_b", "invalid_ratio", None, gridsize=80))
    # decimals a row, or the quotients written out again in a filter on the keys, took 50 microseconds a row
    assert "bround" not in plan and plan.count(" % ") <= 4
    assert "Filter (" not in plan[plan.index("Exchange"):]
    grid = [(x / 4, y / 4) for x in range(41) for y in range(29)] + [(None, 1.0), (1.0, None)]
    got = {(r.lattice, r.ix, r.iy): r.n for r in hexbin.hex_bin(spark.createDataFrame(grid, "x double, y double"), "x", "y", gridsize=10).collect()}
    x, y = np.array(grid[:-2]).T
    lo, hi, ny = -1e-9 * 10, 10 + 1e-9 * 10, int(10 / math.sqrt(3))
    px, py = (x - lo) / ((hi - lo) / 10), y / (7 / ny)
    a, b = (np.round(px), np.round(py)), (np.floor(px), np.floor(py))
    first = (px - a[0]) ** 2 + 3 * (py - a[1]) ** 2 < (px - b[0] - 0.5) ** 2 + 3 * (py - b[1] - 0.5) ** 2
    want = {}
    for f, ix, iy in zip(first, np.where(first, a[0], b[0]), np.where(first, a[1], b[1])):
        if 0 <= ix < 10 + f and 0 <= iy < ny + f:
            key = (1 if f else 2, int(ix), int(iy))
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_rank_joins_see_counts_only(spark, no_broadcast):
    """The side that is joined on the hot value is an aggregate."""
    d = spark.range(4000).select((F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 50).cast("double").alias("p"))
    plan = _plan(stats.spearman(d, "p", "y"))
    assert "SortMergeJoin" not in plan.split("HashAggregate")[-1]
    pdf = d.toPandas()
    assert stats.spearman(d, "p", "y").first()["rho"] == pytest.approx(pdf.p.rank().corr(pdf.y.rank()))


@pytest.mark.parametrize("rings", [3, 1])
def test_nearest_cell_however_far(spark, rings):
    r = np.random.default_rng(4)
    known = {(int(a), int(b)) for a, b in r.integers(0, 40, (80, 2))} | {(-90_000, 5), (70_000, 70_001)}
    unseen = {(int(a), int(b)) for a, b in r.integers(-60, 100, (40, 2))} | {(1_000_000, -3), (-90_500, 900), (20_000, 20_000)}
    unseen -= known
    k = spark.createDataFrame(sorted(known), "grid_lon long, grid_lat long")
    u = spark.createDataFrame(sorted(unseen), "grid_lon long, grid_lat long")
    out = {(x.grid_lon, x.grid_lat): (x.near_x, x.near_y, x.dist) for x in lookup.nearest_known(u, k, rings=rings).collect()}
    for a in unseen:
        best = min(known, key=lambda c: ((a[0] - c[0]) ** 2 + (a[1] - c[1]) ** 2, c[0] * 100000 + c[1]))
        assert out.pop(a) == (*best, pytest.approx(math.dist(a, best)))
    assert not out


def test_row_key_beyond_any_test_scale(spark):
    cols = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double"
    li = spark.createDataFrame([(10 ** 9, 7, 2 * 10 ** 10, 10 ** 9, 1e5), (10 ** 9, 6, 2 * 10 ** 10, 10 ** 9, 1e5), (10 ** 12, 7, 1, 1, 9e4)], cols)
    keys = [r[0] for r in li.selectExpr(f"{fixtures.INNER_EXPRS[0][0]} as k").collect()]
    assert len(set(keys)) == 3 and min(keys) >= 0
    z = fixtures.zone_obs(spark, SF_SMALL)
    assert z.select("row_id").distinct().count() == z.count()


def test_samples_do_not_follow_folds():
    import duckdb
    for seed in (0, 1, 42):
        n = duckdb.sql(f"select f, count(*) from (select {sqltext.fold_sql(5)} f from range(2000000) t(row_id) "
                       f"order by {sqltext.mix_sql('row_id', seed)} limit 200) group by 1").fetchall()
        assert len(n) == 5 and min(c for _, c in n) > 15


def test_raw_blends_tie_only_if_equal(spark):
    d = spark.createDataFrame([(0.1 + i * 1e-12, float(i), 0.0) for i in range(50)], "a double, y double, b double")
    one = {r.point: r.rho for r in ensemble.blend_curve(d, ["a", "b"], "y", 1).collect()}
    assert one[1] == pytest.approx(1.0) and one[0] is None
    assert {r.point: r.rho for r in ensemble.blend_curve(d, ["a", "b"], "y", 1, digits=9).collect()}[1] is None


@pytest.mark.parametrize("bins", [7, 4096])
def test_bounds_hold(spark, bins):
    r = np.random.default_rng(3)
    y = r.integers(0, 6, 800)
    rows = [(float(a), float(b), float(c), float(v)) for a, b, c, v in zip(y + r.normal(0, 2, 800), r.normal(0, 1, 800) ** 3, -y + r.normal(0, 1, 800), y)]
    d = spark.createDataFrame(rows, "a double, b double, c double, y double")
    exact = {x.point: x.rho for x in ensemble.blend_curve(d, ["a", "b", "c"], "y", 10).collect()}
    bounds = {x.point: (x.low, x.high) for x in ensemble.rho_bounds(d, ["a", "b", "c"], "y", 10, bins=bins).collect()}
    assert set(exact) == set(bounds)
    assert all(bounds[p][0] <= rho <= bounds[p][1] for p, rho in exact.items())
    if bins > 1000:
        assert sum(h >= max(low for low, _ in bounds.values()) for _, h in bounds.values()) < len(bounds) / 4
    best = ensemble.blend_search(d, ["a", "b", "c"], "y", 10).first()
    assert (best.point, best.rho) == (max(exact, key=lambda p: (exact[p], -p)), pytest.approx(max(exact.values())))


def test_ranges_of_a_curve_leave_no_trace(spark, monkeypatch):
    """Ties, NaN, null groups and constant blends over one range of values and over many; no row is exploded by points."""
    r = np.random.default_rng(5)
    rows = [(float(round(a, 1)) if i % 50 else float("nan"), float(b), float(v), None if i % 3 else "g") for i, (a, b, v) in enumerate(zip(r.normal(0, 1, 900), r.random(900), r.integers(0, 5, 900)))]
    d = spark.createDataFrame(rows, "a double, b double, y double, g string").withColumn("c", F.lit(0.25))
    one = {(x.g, x.point): (x.rho, x.n) for x in ensemble.blend_curve(d, ["a", "b"], "y", 10, by=["g"]).collect()}
    monkeypatch.setattr(ensemble, "_RANGE", 40)
    curve = ensemble.blend_curve(d, ["a", "b"], "y", 10, by=["g"])
    assert "Generate" not in curve._jdf.queryExecution().optimizedPlan().toString()
    many = {(x.g, x.point): (x.rho, x.n) for x in curve.collect()}
    assert len(many) == 22 and {k[0] for k in many} == {None, "g"}
    assert all(many[k][0] == pytest.approx(one[k][0], abs=1e-12) and many[k][1] == one[k][1] for k in one)
    pd = d.toPandas()
    for g, own in (("g", pd[pd.g == "g"]), (None, pd[pd.g.isna()])):
        want = (0.3 * own.a + 0.7 * own.b).fillna(np.inf).rank().corr(own.y.rank())
        assert many[g, 3][0] == pytest.approx(want, abs=1e-9)
    assert all(x.rho is None for x in ensemble.blend_curve(d, ["c"], "y", 10).collect())


def test_best_points_are_those_of_the_whole_curve(spark):
    r = np.random.default_rng(6)
    y = r.integers(0, 6, 600)
    d = spark.createDataFrame([tuple(map(float, x)) for x in zip(y + r.normal(0, 2, 600), r.normal(0, 1, 600), -y + r.normal(0, 1, 600), y)], "a double, b double, c double, y double")
    whole = sorted(ensemble.blend_curve(d, ["a", "b", "c"], "y", 12).collect(), key=lambda x: (-x.rho, x.point))
    some = sorted(ensemble.best_curve(d, ["a", "b", "c"], "y", 12, best=5).collect(), key=lambda x: (-x.rho, x.point))
    assert [x.point for x in some[:5]] == [x.point for x in whole[:5]] and len(some) < len(whole) / 2


def test_fold_models_leave_their_fold_out(spark):
    """Rows whose target can't be guessed from others: the model of a fold must not know them."""
    d = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 4).cast("int").alias("fold"),
                                (F.col("id") % 4).cast("double").alias("x"), F.when(F.col("id") % 4 == 1, 9.0).otherwise(0.0).alias("y"),
                                F.lit(1.0).alias("w"))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    res = M.oof_train(d, d.select("row_id", "x"), ["x"], "y", folds=range(4), params={"maxIter": 3, "maxDepth": 2}, weight="w")
    rows = res.oof.collect()
    assert sorted(r.row_id for r in rows) == list(range(400))
    assert all(r.pred == pytest.approx(0.0, abs=1e-6) for r in rows if r.fold == 1)
    test = res.test.collect()
    assert len(test) == 400 and {r.n_folds for r in test} == {4}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_standardise_takes_the_fitted_moments(spark):
    fit = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    held = spark.createDataFrame([(5.0, 5.0), (None, 7.0)], "a double, c double")
    assert [tuple(r) for r in M.standardise(fit, held, ["a", "c"])[1].collect()] == [(3.0, 0.0), (None, 0.0)]


def test_a_killed_fold_is_done_again(spark, tmp_path):
    path = str(tmp_path / "folds")
    assert io.fold_done(spark, path, "m") == []
    p = spark.createDataFrame([(1, "oof", 0.5), (2, "test", 0.7)], "row_id long, kind string, pred double")
    io.checkpoint_fold(p, path, "m", 0)
    os.makedirs(f"{path}/_temporary/0", exist_ok=True)  # what a killed writer of fold 1 leaves
    assert io.fold_done(spark, path, "m") == [0]
    io.checkpoint_fold(p, path, "m", 1)
    io.checkpoint_fold(p, path, "m", 1)
    assert io.fold_done(spark, path, "m") == [0, 1] and spark.read.parquet(path).count() == 4


def test_other_errors_are_raised(spark, tmp_path):
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"no parquet at all")
    with pytest.raises(Exception):
        io.fold_done(spark, str(bad), "m")
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    assert io.load_first(spark, [str(tmp_path / "none"), good])[0] == good
    with pytest.raises(FileNotFoundError):
        io.load_first(spark, [str(tmp_path / "none")])


def test_gate():
    assert checks.gate(0.6, 0.5) and not checks.gate(0.4, 0.5)


def test_changed_input_changes_the_features(spark, tmp_path):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    path = f"{tmp_path}/lineitem.parquet"
    li.write.parquet(path)
    a = common.tier2(spark, str(tmp_path))[0].count()
    assert common.tier2(spark, str(tmp_path))[0].count() == a
    li.limit(3000).write.mode("overwrite").parquet(path)
    assert common.tier2(spark, str(tmp_path))[0].count() < a


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from zonekit import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(ValueError):
        session.shared_dir(Session())
