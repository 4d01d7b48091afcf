"""Model jobs: early stop, explanation, search, categories, recovery and layers, each against a plain version."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from zonekit.functions import features as fx
from zonekit.operators import encode, models as M, stats, trees
from zonekit.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(0)
    x = r.random((3000, 5))
    y = np.clip(x[:, 0] * x[:, 1] + 0.3 * (x[:, 2] > 0.6) + 0.2 * r.standard_normal(3000), 0, 1)
    data = [(i, i % 5, *map(float, a), float(b), int(1 + i % 7)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, fold int, a double, b double, c double, d double, e double, y double, n int").repartition(4)
    df = df.cache()
    df.count()
    return df


def holes(df):
    return df.withColumn("e", F.when(F.col("row_id") % 11 == 0, None).otherwise(F.col("e")))


X = ["a", "b", "c", "d", "e"]


def fitted(df, kind="gbt", **params):
    if kind == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol="y", predictionCol="pred", numTrees=4, maxDepth=4, seed=1).fit(M.assemble(df, X))
    return GBTRegressor(featuresCol="features", labelCol="y", predictionCol="pred", **{"maxIter": 12, "maxDepth": 3, "seed": 1, "stepSize": 0.4, **params}).fit(M.assemble(df, X))


def matrix(df):
    got = df.orderBy("row_id").collect()
    return np.array([[float("nan") if r[f] is None else r[f] for f in X] for r in got]), np.array([r.y for r in got]), [r.row_id for r in got]


# ---- staged losses ------------------------------------------------------------------------------------------

def test_staged_loss_and_truncation(rows):
    fit, held = rows.where("fold != 0"), rows.where("fold = 0")
    model = fitted(fit)
    ts = trees.read_trees(model)
    losses = trees.staged_loss(ts, held, X, "y")
    for k in (1, 4, 12):
        short = trees.truncated(model, k)
        assert short.getNumTrees == k
        want = short.transform(M.assemble(held, X)).select(F.avg((F.col("pred") - F.col("y")) ** 2)).first()[0]
        assert math.isclose(losses[k - 1], want, rel_tol=1e-9)
    x, y, _ = matrix(held)
    assert np.allclose(sum(t.weight * t.predict(x) for t in ts), [r.pred for r in model.transform(M.assemble(held, X)).orderBy("row_id").collect()])
    assert trees.staged_loss(ts, held.limit(0), X, "y") == []


def test_best_prefix():
    assert trees.best_prefix([5, 4, 3, 3, 4, 4, 2], 3) == 3      # three trees without a better one: the 2 is never seen
    assert trees.best_prefix([5, 4, 3, 3, 4, 4, 2], 4) == 7
    assert trees.best_prefix([1, 2, 3], 50) == 1 and trees.best_prefix([3, 2, 1], 1) == 3 and trees.best_prefix([], 5) == 0
    assert M.at_limit([30, 21, 20, 19, 0], 30) == 3


def test_patience_in_folds(rows):
    res = M.oof_train(rows, rows.limit(50), X, "y", params={"maxIter": 25, "maxDepth": 4, "stepSize": 0.5}, patience=3)
    assert len(res.best_iters) == 5 and all(1 <= b <= 25 for b in res.best_iters) and min(res.best_iters) < 25
    for k, model in enumerate(res.models):
        held = rows.where(F.col("fold") == k)
        losses = trees.staged_loss(trees.read_trees(model), held, X, "y")
        assert len(losses) == res.best_iters[k] == int(np.argmin(losses)) + 1  # later trees are gone
        got = res.oof.where(F.col("fold") == k).orderBy("row_id").select("pred").collect()
        want = model.transform(M.assemble(held, X)).orderBy("row_id").select("pred").collect()
        assert got == want


# ---- explanation --------------------------------------------------------------------------------------------

def expected(tree, x, known, node=0):
    """Value of a tree where only ``known`` features of x count; others follow the training weight."""
    if tree.left[node] < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        return expected(tree, x, known, left if tree.goes_left(node, x[None])[0] else right)
    return (tree.cover[left] * expected(tree, x, known, left) + tree.cover[right] * expected(tree, x, known, right)) / tree.cover[node]


def brute(ts, x):
    p = len(x)
    value = {s: sum(t.weight * expected(t, x, set(s)) for t in ts) for n in range(p + 1) for s in itertools.combinations(range(p), n)}
    out = []
    for i in range(p):
        others = [j for j in range(p) if j != i]
        out.append(sum(math.factorial(n) * math.factorial(p - 1 - n) / math.factorial(p) * (value[tuple(sorted((*s, i)))] - value[s])
                       for n in range(p) for s in itertools.combinations(others, n)))
    return out, value[()]


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_shapley_values(rows, kind):
    model = fitted(rows, kind)
    ts = trees.read_trees(model)
    sample = holes(rows.where("row_id < 400"))
    got = trees.explain(model, sample, X).orderBy("row_id").collect()
    pred = {r.row_id: r.pred for r in model.transform(M.assemble(sample, X)).collect()}
    x, _, ids = matrix(sample)
    assert [r.row_id for r in got] == ids
    for i, r in enumerate(got):
        assert math.isclose(r.base + sum(r[f"shap_{f}"] for f in X), r.prediction, abs_tol=1e-9)
        assert math.isclose(r.prediction, pred[r.row_id], abs_tol=1e-9)
        if i % 20 == 0:
            phi, base = brute(ts, x[i])
            assert np.allclose(phi, [r[f"shap_{f}"] for f in X], atol=1e-9) and math.isclose(base, r.base, abs_tol=1e-9)


def test_explain_without_rows_or_splits(rows):
    assert trees.explain(fitted(rows), rows.limit(0), X).count() == 0
    flat = rows.withColumn("y", F.lit(0.25))
    r = trees.explain(fitted(flat), flat.limit(3), X).collect()
    assert all(math.isclose(x.prediction, 0.25) and x.shap_a == 0 for x in r)


def test_categorical_splits(spark):
    """A tree that splits a category by a set of values."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    r = random.Random(2)
    df = spark.createDataFrame([(i, r.choice("pqrs"), r.random()) for i in range(600)], "row_id long, k string, a double")
    df = df.withColumn("y", F.when(F.col("k").isin("p", "r"), 1.0).otherwise(0.0) + F.col("a") / 10)
    df = StringIndexer(inputCol="k", outputCol="ki").fit(df).transform(df)
    model = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="pred", maxIter=3, maxDepth=3).fit(
        VectorAssembler(inputCols=["ki", "a"], outputCol="features").transform(df))
    assert any(t.categories for t in trees.read_trees(model))
    pred = {x.row_id: x.pred for x in model.transform(VectorAssembler(inputCols=["ki", "a"], outputCol="features").transform(df)).collect()}
    for x in trees.explain(model, df, ["ki", "a"]).collect():
        assert math.isclose(x.prediction, pred[x.row_id], abs_tol=1e-9)


# ---- guided search ------------------------------------------------------------------------------------------

def test_search_follows_scores():
    """On a known score the guided draws end nearer the best value than random ones."""
    space = {"x": (0.0, 1.0), "n": (1, 100), "r": (0.001, 1.0, "log"), "c": ["u", "v", "w"]}
    score = lambda p: -abs(p["x"] - 0.8) - abs(p["n"] - 30) / 100 - abs(math.log10(p["r"]) + 2) / 3 - 0.3 * (p["c"] != "v")
    guided, plain = [], []
    for seed in range(12):
        rng, done = random.Random(seed), []
        for _ in range(40):
            p = M.propose(space, done, rng, startup=8)
            assert 0 <= p["x"] <= 1 and 1 <= p["n"] <= 100 and isinstance(p["n"], int) and 0.001 <= p["r"] <= 1 and p["c"] in "uvw"
            done.append((p, score(p)))
        guided.append(np.mean([s for _, s in done[20:]]))
        plain.append(np.mean([s for _, s in [(p, score(p)) for p in (M.propose(space, [], rng, 8) for _ in range(20))]]))
    assert np.mean(guided) > np.mean(plain) + 0.2
    assert M.best_trial([({"x": 1}, None), ({"x": 2}, 0.5), ({"x": 3}, 0.5)]) == {"x": 2}
    with pytest.raises(ValueError):
        M.best_trial([({}, None)])


def test_search_job(rows, monkeypatch):
    asked = []

    class Result:
        def __init__(self, p):
            self.fold_scores = rows.limit(1).select(F.lit(0, ).cast("int").alias("fold"), F.lit(-abs(p["stepSize"] - 0.2)).alias("rho"))

    def job(train, test, features, label, fold_col, folds, params, weight, parallel):
        asked.append(params)
        assert weight == "n" and params["maxIter"] == 4
        return Result(params)
    monkeypatch.setattr(M, "oof_train", job)
    space = {"stepSize": (0.01, 1.0, "log")}
    first = M.guided_search(rows, X, "y", space, n_trials=10, together=3, weight="n", params={"maxIter": 4})
    assert len(first) == len(asked) == 10 and first == M.guided_search(rows, X, "y", space, n_trials=10, together=3, weight="n", params={"maxIter": 4})
    assert math.isclose(M.best_trial(first)["stepSize"], min((p["stepSize"] for p, _ in first), key=lambda s: abs(s - 0.2)))


# ---- categories ---------------------------------------------------------------------------------------------

def test_dense_index(spark):
    r = random.Random(1)
    values = [int(r.paretovariate(0.6)) for _ in range(3000)]
    got = {x.v: (x["rows"], x["index"]) for x in M.dense_index(spark.createDataFrame([(v,) for v in values] + [(None,)], "v long"), "v").collect()}
    want = sorted(set(values), key=lambda v: (-values.count(v), v))
    assert got == {v: (values.count(v), i) for i, v in enumerate(want)}


def test_ordered_bins(rows):
    df = rows.withColumn("cell", F.floor(F.col("a") * 400)).withColumn("cell", F.when(F.col("row_id") == 7, F.lit(9999)).otherwise(F.col("cell")))
    bins = M.ordered_bins(df, "cell", "y", 8, smooth=0.0)
    data = df.select("row_id", "fold", "cell", "y").collect()
    got = {(r.fold, r.cell): r.bin for r in bins.collect()}
    assert set(got.values()) == set(range(8))
    for k in range(5):
        by = {}
        for r in data:
            if r.fold != k:
                by.setdefault(r.cell, []).append(r.y)
        order = sorted(by, key=lambda c: (np.float32(np.mean(by[c])), c))
        placed = [got[k, c] for c in order]
        assert placed == sorted(placed)  # means never fall from bin to bin
        assert {c for f, c in got if f == k} == set(by)
        sizes = [sum(len(by[c]) for c in by if got[k, c] == b) for b in range(8)]
        assert max(sizes) < 2 * sum(sizes) / 8
    alone = next(r.fold for r in data if r.cell == 9999)
    seen = M.with_bins(df.where("row_id = 7"), bins, alone, "cell", 8).first()
    assert seen.bin == 8.0  # unseen outside its own fold: a bin of its own
    assert M.with_bins(df.where("row_id = 7"), bins, (alone + 1) % 5, "cell", 8).first().bin < 8
    res = M.oof_train(df, None, [*X, "bin"], "y", params={"maxIter": 2, "maxBins": 32},
                      per_fold=lambda k, d: M.with_bins(d, bins, k, "cell", 8))
    assert res.oof.count() == rows.count()


def test_bins_do_not_follow_the_number_of_cells(rows):
    many = rows.withColumn("cell", F.col("row_id"))
    assert M.ordered_bins(many, "cell", "y", 8).agg(F.countDistinct("bin"), F.max("bin")).first() == (8, 7)


# ---- recovery -----------------------------------------------------------------------------------------------

def test_resumed_run_fits_only_missing_folds(spark, rows, monkeypatch):
    path = scratch_path(spark, "resume")
    real, fits = M._learner, []

    alive = {"for": 2}

    def dies(kind, *a, **b):
        if len(fits) >= alive["for"]:
            raise RuntimeError("executors lost")
        fits.append(kind)
        return real(kind, *a, **b)
    monkeypatch.setattr(M, "_learner", dies)
    params = {"maxIter": 3, "maxDepth": 3}
    with pytest.raises(RuntimeError):
        M.oof_train(rows, rows.limit(40), X, "y", params=params, path=path, parallel=1)
    alive["for"] = 1000
    again = M.oof_train(rows, rows.limit(40), X, "y", params=params, path=path, parallel=1)
    assert len(fits) == 5 and again.resumed == [0, 1]  # folds 2, 3 and 4
    whole = M.oof_train(rows, rows.limit(40), X, "y", params=params)
    assert sorted(again.oof.collect()) == sorted(whole.oof.collect())
    assert sorted(again.test.collect()) == sorted(whole.test.collect())
    assert [m.getNumTrees for m in again.models] == [m.getNumTrees for m in whole.models] == [3] * 5
    assert M.oof_train(rows, rows.limit(40), X, "y", params=params, path=path).resumed == [0, 1, 2, 3, 4] and len(fits) == 10


# ---- layers -------------------------------------------------------------------------------------------------

def test_extra_rows_join_fit_sides_only(rows):
    """Pseudo rows with a wild target change every model, and no held-out row is one of them."""
    extra = rows.limit(300).select(*X, F.lit(50.0).alias("y"), F.lit(1.0).alias("w"))
    df = rows.withColumn("w", F.lit(1.0))
    res = M.oof_train(df, None, X, "y", params={"maxIter": 2}, weight="w", extra_fit=extra)
    assert res.oof.count() == rows.count() and res.oof.agg(F.max("y")).first()[0] <= 1.0
    assert res.oof.agg(F.avg("pred")).first()[0] > 2.0


@pytest.mark.parametrize("drop, steps", [(0.0, ["base", "layer1", "layer2"]), (0.1, ["base", "layer1"])])
def test_layer_gate(spark, monkeypatch, drop, steps):
    from zonekit.plans import q_models
    te = spark.createDataFrame([(i, float(i)) for i in range(100)], "row_id long, f double")
    test = te.select("row_id", (F.col("row_id") / 100).alias("p_gbt"), (F.col("row_id") / 100).alias("p_rf"))
    calls = []

    def pair(tr, te, feats, extra=None):
        calls.append(None if extra is None else extra.collect())
        return None, test, {"rho": 0.5 - (drop if extra is not None else 0.0), "w_p_gbt": 0.5}
    monkeypatch.setattr(q_models, "_two_learners", pair)
    rows = q_models.pseudo_curriculum(None, te, ["f"])
    assert [r[0] for r in rows] == steps and [r[4] for r in rows] == [True] * (len(steps) - 1) + [drop == 0.0]
    assert {round(r.y_rank, 2) for r in calls[1]} == {0.0, 0.01, 0.99} and {r.weight for r in calls[1]} == {0.7}
    if drop == 0.0:
        assert rows[2][3] == len(calls[2]) > len(calls[1]) and {r.weight for r in calls[2]} == {0.3, 0.7}


# ---- encodings ----------------------------------------------------------------------------------------------

def test_single_fold_key_takes_the_key_above(spark):
    """A period cell that stands in one fold only carries its cell's out-of-fold encoding, not the mean."""
    data = [(i, i % 3, 1, 10, 1.0) for i in range(6)] + [(6, 0, 1, 11, 0.0), (7, 1, 2, 20, 0.0), (8, 2, 2, 20, 0.0), (9, 0, 3, 30, 0.25)]
    df = spark.createDataFrame(data, "row_id long, fold int, cell int, period int, invalid_ratio double")
    te = spark.createDataFrame([(0, 1, 10), (1, 1, 99), (2, 9, 99)], "row_id long, cell int, period int")
    tr, test = encode.chained_encodings(df, te, [("cell", 3.0, "cell_te"), ("period", 5.0, "period_te")])
    got = {r.row_id: r for r in tr.collect()}
    f32 = lambda v: float(np.float32(v))
    mu = sum(r[4] for r in data) / len(data)
    own = f32((4 * 1.0 + 3 * mu) / (4 + 3))  # cell 1 in the other folds: rows 1, 2, 4, 5
    assert math.isclose(got[6].cell_te, own) and math.isclose(got[6].period_te, own)
    assert not math.isclose(got[6].period_te, f32(mu))
    assert math.isclose(got[9].cell_te, f32(mu)) and math.isclose(got[9].period_te, f32(mu))  # neither level: the mean
    assert math.isclose(got[0].period_te, f32((4 * 1.0 + 5 * mu) / 9))
    t = {r.row_id: r for r in test.collect()}
    assert math.isclose(t[1].period_te, t[1].cell_te) and math.isclose(t[2].period_te, f32(mu)) and t[0].period_te != t[0].cell_te


# ---- exact KS -----------------------------------------------------------------------------------------------

def test_exact_p_value_equals_enumeration():
    for n in range(1, 9):
        for m in range(1, 9):
            found = {}
            for first in itertools.combinations(range(n + m), n):
                a = b = h = 0
                for i in range(n + m):
                    a, b = (a + 1, b) if i in first else (a, b + 1)
                    h = max(h, abs(a * m - b * n))
                found[h] = found.get(h, 0) + 1
            total = math.comb(n + m, n)
            for h in found:
                assert math.isclose(stats.ks_exact(h, n, m), sum(c for x, c in found.items() if x >= h) / total, abs_tol=1e-15), (n, m, h)
    assert stats.ks_exact(0, 5, 5) == 1.0


def test_ks_test_by_group(spark):
    r = random.Random(3)
    data = [("small", r.random(), s) for s in ("train",) * 9 + ("test",) * 6] + [("large", r.random() ** (1 + (s == "test")), s) for s in ("train", "test") * 400]
    data += [("one", 1.0, "train")] * 3 + [(None, 0.5, "train"), (None, 0.5, "test")]
    got = {x.g: x for x in stats.ks_test(spark.createDataFrame(data, "g string, v double, s string"), "v", "s", by=["g"]).collect()}
    assert set(got) == {"small", "large", None}  # a group of one sample has no test
    assert got["small"].exact and not got["large"].exact and got["large"].p_value < 0.01 and got[None].p_value == 1.0
    h = round(got["small"].ks * 54)
    assert math.isclose(got["small"].p_value, stats.ks_exact(h, 9, 6))
    asked = stats.ks_test(spark.createDataFrame(data, "g string, v double, s string"), "v", "s", by=["g"], exact_values=1000)
    large = {x.g: x for x in asked.collect()}["large"]
    assert large.exact and math.isclose(large.p_value, got["large"].p_value, rel_tol=0.3)


def test_fits_at_once_follow_the_storage_memory(spark):
    """Five folds of few rows run side by side, of very many rows one after the other; no count of rows ends at none."""
    assert M.side_by_side(spark, 1_000, 28, 5) == 5
    assert M.side_by_side(spark, 10 ** 12, 28, 5) == 1
    assert M.side_by_side(spark, 0, 28, 5) == 5


def test_permuted_rows_are_joined_once(spark):
    """The permuted value of a feature is the one the row order gives; scoring a feature joins nothing again."""
    n = 200
    d = spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") * 37 % 101).cast("double").alias("a"),
                              (F.col("id") * 53 % 89).cast("double").alias("b"), (F.col("id") * 37 % 101).cast("double").alias("y"))
    plans = []

    class First:
        def transform(self, df):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return df.withColumn("pred", vector_to_array("features")[0])

    got = {r.feature: r.rho_drop for r in M.permutation_importance(First(), d, ["a", "b"], "y").collect()}
    rows = d.select("row_id", "a", "y", fx.mix32("row_id", 99).alias("h")).toPandas().sort_values("row_id")
    mixed = rows.sort_values(["h", "row_id"])["a"].to_numpy()
    want = 1 - np.corrcoef(pd.Series(mixed).rank(), rows["y"].rank())[0, 1]
    assert got["b"] == pytest.approx(0) and got["a"] == pytest.approx(want)
    assert len(plans) == 3 and not any("Join" in p for p in plans)


def test_fits_at_once_count_the_executors_only(spark, monkeypatch):
    """The driver's smaller memory isn't taken for that of an executor; rounds hold about as many fits each."""
    rows, room = 3_300_000, 943_718_400
    assert [M.fits_at_once(n * room, rows, 27, 5) for n in (1, 3, 5, 12)] == [1, 2, 3, 5]
    assert M.fits_at_once(7 * room, rows, 27, 12) == 4
    asked = []
    monkeypatch.setattr(M, "fits_at_once", lambda storage, *rest: asked.append(storage) or 1)
    M.side_by_side(spark, rows, 27, 5)
    info = spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()
    assert asked == [info[0].totalOnHeapStorageMemory()] and len(info) == 1


def test_rows_of_a_fit_stay_out_of_storage_memory(spark, monkeypatch):
    """While folds are fitted, the assembled rows are on disk and hold only what a fold reads."""
    rows = spark.createDataFrame([(i, i % 2, float(i), float(i % 7), "text") for i in range(60)], "row_id long, fold int, x double, y double, other string")
    info = spark.sparkContext._jsc.sc().getRDDStorageInfo
    seen, own, before = [], M._learner, {r.id() for r in info()}

    def learner(*args):
        one = own(*args)

        class Fit:
            def fit(self, df):
                kept = [r for r in info() if r.id() not in before]
                seen.append((df.columns, [r.storageLevel().useMemory() for r in kept]))
                return one.fit(df)
        return Fit()
    monkeypatch.setattr(M, "_learner", learner)
    res = M.oof_train(rows, None, ["x"], "y", folds=(0, 1), params={"maxIter": 1, "maxDepth": 2}, parallel=1)
    assert res.oof.count() == 60 and len(seen) == 2
    assert seen[0][0] == ["features", "y"] and seen[0][1] and not any(seen[0][1])
