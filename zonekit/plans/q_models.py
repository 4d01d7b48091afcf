"""Registered model-job queries (K1-K20, G16). Rows-only checks: MLlib scores are
not the reference's learners' scores, only the job semantics are reproduced."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode, ensemble as E, models as M, ranks, split, stats, transform, trees
from ..session import scratch_path, stored
from . import pipeline
from . import sqltext as S
from .common import fold_files, keyed_split, tier2
from .registry import query, r6

_Y = "invalid_ratio"
#: Encodings of months 1-5, each falling back on the one before: (key, smoothing, column).
_CHAIN = [("grid_id", 30.0, "grid_te"), ("grid_period", 50.0, "grid_period_te")]
_FAST = {"maxIter": 10, "maxDepth": 4}


def _feats(df):
    return [c for c in pipeline.feature_columns(df) if c not in ("pred_a", "pred_b", "split")]


def _fold_table(res: M.OOFResult, score_col: str = _Y):
    overall = stats.spearman(res.oof, "pred", score_col).select(F.lit("all").alias("fold"), "rho")
    per = res.fold_scores.select(F.col("fold").cast("string").alias("fold"), "rho")
    return per.unionByName(overall).select("fold", r6("rho"))


@query("k1_rf_baseline")
def k1_rf_baseline(spark, sf):
    tr, te = keyed_split(spark, sf)
    a, _ = pipeline.fill_missing(tr, te)
    sample = split.sample_n(a, 500000, seed=42)
    return M.rf_baseline(sample, ["total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month"], _Y)


@query("k2_oof_train")
def k2_oof_train(spark, sf):
    tr, te = tier2(spark, sf)
    res = M.oof_train(tr, te, _feats(tr), _Y, params=_FAST, files=True)
    return _fold_table(res)


@query("k2_test_mean")
def k2_test_mean(spark, sf):
    """K2's second output: the mean of the fold models for every test row."""
    tr, te = tier2(spark, sf)
    return M.oof_train(tr, te, _feats(tr), _Y, params=_FAST, files=True).test.select("row_id", r6("pred"), "n_folds")


@query("k2_resumed")
def k2_resumed(spark, sf):
    """A run that ended after two folds, taken up again: the finished folds are read, the others fitted."""
    tr, te = tier2(spark, sf)
    path = scratch_path(spark, "k2")
    M.oof_train(tr, te, _feats(tr), _Y, folds=(0, 1), params=_FAST, path=path, files=True)
    res = M.oof_train(tr, te, _feats(tr), _Y, params=_FAST, path=path, files=True)
    return _fold_table(res).withColumn("resumed", F.col("fold").isin([str(k) for k in res.resumed]))


_LIMIT, _PATIENCE = 30, 5


def _stopped(tr):
    return M.oof_train(tr, None, _feats(tr), _Y, params={**_FAST, "maxIter": _LIMIT, "stepSize": 0.3}, patience=_PATIENCE, files=True)


@query("k3_early_stop")
def k3_early_stop(spark, sf):
    """Trees up to the best one on the held-out fold; the search for a better one ends after five without."""
    tr, _ = tier2(spark, sf)
    res = _stopped(tr)
    trees = spark.createDataFrame([(str(k), n) for k, n in enumerate(res.best_iters)], "fold string, n_trees int")
    return _fold_table(res).join(trees, on="fold", how="left")


@query("k4_weighted")
def k4_weighted(spark, sf):
    tr, _ = tier2(spark, sf)
    tr = tr.withColumn("weight", fx.sample_weight("total_count"))
    return _fold_table(M.oof_train(tr, None, _feats(tr.drop("weight")), _Y, params=_FAST, weight="weight", files=True))


@query("k5_rank_target")
def k5_rank_target(spark, sf):
    tr, _ = tier2(spark, sf)
    tr = fold_files(ranks.average_rank(tr, _Y, out="y_rank", normalise=True, written=True), "rank_target")
    res = M.oof_train(tr, None, _feats(tr.drop("y_rank")), "y_rank", params=_FAST, score_col=_Y, files=True)
    return _fold_table(res)


@query("k6_ablation")
def k6_ablation(spark, sf):
    tr, _ = tier2(spark, sf)
    rows = []
    for name, cols in pipeline.cumulative_groups().items():
        res = M.oof_train(tr, None, cols, _Y, params=_FAST, files=True)
        rho = stats.spearman(res.oof, "pred", _Y).select("rho").collect()[0][0]
        rows.append((name, len(cols), float(rho) if rho is not None else None))
    return spark.createDataFrame(rows, "feature_set string, n_features int, oof_rho double")


@query("k7_mean_importance")
def k7_mean_importance(spark, sf):
    tr, _ = tier2(spark, sf)
    feats = _feats(tr)
    res = M.oof_train(tr, None, feats, _Y, params=_FAST, files=True)
    return M.mean_importance(res.models, feats).orderBy(F.col("importance").desc(), "feature")


_ADV_FEATS = ["total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month"]


def _adversarial(tr, te):
    fold_auc, _, _ = M.adversarial_validation(tr, te, _ADV_FEATS, params=_FAST)
    mean = fold_auc.agg(F.avg("auc").alias("auc")).select(F.lit("mean").alias("fold"), "auc")
    return fold_auc.select(F.col("fold").cast("string"), "auc").unionByName(mean).select("fold", r6("auc"))


@query("k8_adversarial_validation")
def k8_adversarial_validation(spark, sf):
    return _adversarial(*tier2(spark, sf))


@query("k8_adversarial_months")
def k8_adversarial_months(spark, sf):
    """The same against the train rows of the test months (1 to 5) only."""
    tr, te = tier2(spark, sf)
    return _adversarial(tr.where("month <= 5"), te)


def _adv_model(spark, sf):
    tr, te = tier2(spark, sf)
    lab = split.label_sources(split.balance(tr, te), te, ["row_id", *_ADV_FEATS], "is_test")
    m = M._learner("gbt_clf", "is_test", _FAST).fit(M.assemble(lab, _ADV_FEATS))
    return m, tr, te


@query("k9_test_likeness")
def k9_test_likeness(spark, sf):
    m, tr, _ = _adv_model(spark, sf)
    t = M.test_likeness(m, tr, _ADV_FEATS)
    return t.groupBy("month").agg(r6(F.avg("p_test"), "mean_p_test"), F.count(F.lit(1)).alias("n"))


@query("k10_temporal_validation")
def k10_temporal_validation(spark, sf):
    tr, _ = tier2(spark, sf)
    feats = _feats(tr)
    fit, valid = split.temporal_split(tr)
    t = M.fit_score(fit, valid, feats, _Y, _FAST).select(F.lit("temporal_1_4_to_5").alias("scheme"), "rho")
    r = M.oof_train(tr, None, feats, _Y, params=_FAST, files=True).fold_scores.agg(F.avg("rho").alias("rho")) \
        .select(F.lit("random_folds").alias("scheme"), "rho")
    return t.unionByName(r).select("scheme", r6("rho"))


@query("k11_av_weighted")
def k11_av_weighted(spark, sf):
    m, tr, _ = _adv_model(spark, sf)
    feats = _feats(tr)
    t = M.test_likeness(m, tr, _ADV_FEATS).withColumn("av_weight", fx.av_weight("total_count", "p_test")).drop("p_test")
    t = fold_files(t, "av_weights")  # the classifier scores a row once, not in every pass of every fold
    base = M.oof_train(tr, None, feats, _Y, params=_FAST, files=True).fold_scores.agg(F.avg("rho")).collect()[0][0]
    wtd = M.oof_train(t, None, feats, _Y, params=_FAST, weight="av_weight", files=True).fold_scores.agg(F.avg("rho")).collect()[0][0]
    gain = (wtd or 0.0) - (base or 0.0)
    return spark.createDataFrame([(float(base), float(wtd), float(gain), gain > 0.001)],
                                 "base_rho double, weighted_rho double, gain double, keep boolean")


@query("k12_noise_strategies")
def k12_noise_strategies(spark, sf):
    """Noise rows (tc=1 and confidently contradicted by an OOF prediction): remove from fit, down-weight
    to 0.1, or smooth labels to 0.8/0.2. All fits weight by log1p(count) and are scored on the original target."""
    tr, _ = tier2(spark, sf)
    feats = _feats(tr)
    tr = tr.withColumn("w0", fx.sample_weight("total_count"))
    base = M.oof_train(tr, None, feats, _Y, params=_FAST, weight="w0", files=True)
    d = tr.join(base.oof.select("row_id", F.col("pred").alias("oof")), on="row_id")
    noise = transform.noise_candidates("oof", _Y)
    tc1 = F.col("total_count") == 1
    d = d.withColumns({"w": F.when(noise, F.lit(0.1)).otherwise(F.col("w0")),
                       "y_smooth": F.when(noise & tc1 & (F.col(_Y) == 1), 0.8).when(noise & tc1 & (F.col(_Y) == 0), 0.2).otherwise(F.col(_Y)),
                       "is_noise": noise})
    d = fold_files(d, "noise")  # joined once, not by every strategy
    out = [("baseline", base)]
    out.append(("remove", M.oof_train(d, None, feats, _Y, params=_FAST, weight="w0", fit_filter=lambda k: ~F.col("is_noise"), files=True)))
    out.append(("downweight", M.oof_train(d, None, feats, _Y, params=_FAST, weight="w", files=True)))
    out.append(("smooth", M.oof_train(d, None, feats, "y_smooth", params=_FAST, weight="w0", score_col=_Y, files=True)))
    rows = []
    for name, res in out:
        rho = stats.spearman(res.oof, "pred", _Y).select("rho").collect()[0][0]
        rows.append((name, float(rho) if rho is not None else None))
    n_noise = d.where("is_noise").count()
    return spark.createDataFrame(rows, "strategy string, oof_rho double").withColumn("noise_rows", F.lit(n_noise))


_LEARNERS = {"gbt": _FAST, "rf": {"numTrees": 10, "maxDepth": 6}}


def _two_learners(tr, te, feats, extra=None):
    """Both kinds of learner on the rank target, weighted by log1p(count), over rows of files: (their OOF rows side by side, test rows, best blend's rho)."""
    out = {kind: M.oof_train(tr, te, feats, "y_rank", kind=kind, params=params, weight="weight", score_col=_Y, extra_fit=extra, files=True)
           for kind, params in _LEARNERS.items()}
    a, b = (out[kind].oof.withColumnRenamed("pred", f"p_{kind}") for kind in _LEARNERS)
    oof = a.join(b.select("row_id", "p_rf"), on="row_id")
    test = out["gbt"].test.select("row_id", F.col("pred").alias("p_gbt")).join(out["rf"].test.select("row_id", F.col("pred").alias("p_rf")), on="row_id")
    best = E.blend_search(oof, ["p_gbt", "p_rf"], _Y, 20).first()
    return oof, test, best


def pseudo_curriculum(tr, te, feats, hold: float = 0.003, layers=(1, 2)):
    """Rows of K13: the pair of learners alone, then with pseudo-labelled test rows of one layer after the other in every fit side.

    A row's label is the mean of both learners' predicted ranks; it belongs to layer 1 (2) if that lies within 0.02 (0.10) of an end,
    which both learners must agree on. Held-out folds stay as they are. A layer below the base score less ``hold`` ends it.
    ``tr`` and ``te`` are rows of files. Pseudo rows are written too: every pass of every fold reads them.
    """
    _, test, base = _two_learners(tr, te, feats)
    ps = split.pseudo_labels(te.join(test, on="row_id"), ["p_gbt", "p_rf"])
    ps = fold_files(ps.select(*feats, "pseudo_y", "layer", "weight"), "pseudo")
    rows, last = [("base", base["rho"], base["w_p_gbt"], 0, True)], True
    for layer in layers:
        extra = ps.where(F.col("layer") <= layer).select(*feats, F.col("pseudo_y").alias("y_rank"), "weight")
        n = extra.count()
        _, _, best = _two_learners(tr, te, feats, extra)
        last = best["rho"] is not None and best["rho"] >= base["rho"] - hold
        rows.append((f"layer{layer}", best["rho"], best["w_p_gbt"], n, last))
        if not last:
            break
    return rows


@query("k13_pseudo_curriculum")
def k13_pseudo_curriculum(spark, sf):
    tr, te = tier2(spark, sf)
    feats = _feats(tr)
    tr = fold_files(ranks.average_rank(tr, _Y, out="y_rank", normalise=True, written=True).withColumn("weight", fx.sample_weight("total_count")), "rank_target")
    rows = [(s, float(r), float(w), int(n), bool(ok)) for s, r, w, n, ok in pseudo_curriculum(tr, te, feats)]
    return spark.createDataFrame(rows, "step string, oof_rho double, gbt_weight double, pseudo_rows int, passed boolean")


_K13_P = "((least(greatest(pred_a, 0e0), 1e0) + least(greatest(pred_b, 0e0), 1e0)) / 2e0)"


@query("k13_layer_rows", sql=S.keyed_cte() + f"""
, p AS (SELECT {_K13_P} AS y, CASE WHEN {_K13_P} < 0.02 OR {_K13_P} > 0.98 THEN 1 WHEN {_K13_P} < 0.1 OR {_K13_P} > 0.9 THEN 2 END AS layer FROM kte)
, l AS (SELECT * FROM (VALUES (1), (2)) t(step)), f AS (SELECT DISTINCT fold FROM ktr)
, t AS (SELECT f.fold, count(*) FILTER (WHERE g.fold <> f.fold) AS fit, count(*) FILTER (WHERE g.fold = f.fold) AS held,
  sum(g.invalid_ratio) FILTER (WHERE g.fold <> f.fold) AS s FROM f CROSS JOIN ktr g GROUP BY f.fold)
SELECT l.step, t.fold, t.fit AS fit_rows, t.held AS held_rows, (SELECT count(*) FROM p WHERE layer <= l.step) AS pseudo_rows,
 round((t.s + coalesce((SELECT sum(y) FROM p WHERE layer <= l.step), 0)) / (t.fit + (SELECT count(*) FROM p WHERE layer <= l.step)), 6) AS mean_target,
 round(coalesce((SELECT sum(CASE WHEN layer = 1 THEN 0.7e0 ELSE 0.3e0 END) FROM p WHERE layer <= l.step), 0), 6) AS pseudo_weight
FROM l CROSS JOIN t""")
def k13_layer_rows(spark, sf):
    """What each layer adds to each fold: fit and held-out rows, pseudo rows, their weight, the mean target (from two stored predictions)."""
    tr, te = keyed_split(spark, sf)
    ps = split.pseudo_labels(te, ["pred_a", "pred_b"])
    out = None
    for layer in (1, 2):
        pseudo = ps.where(F.col("layer") <= layer).select(F.col("pseudo_y").alias(_Y), F.col("weight").alias("pw"))
        for k in range(5):
            fit, held = split.augment_fold(tr.select("fold", _Y), pseudo, k)
            one = fit.agg(F.count_if(F.col("is_pseudo") == 0).alias("fit_rows"), F.count_if(F.col("is_pseudo") == 1).alias("pseudo_rows"),
                          r6(F.avg(_Y), "mean_target"), r6(F.coalesce(F.sum("pw"), F.lit(0.0)), "pseudo_weight"))
            one = one.select(F.lit(layer).alias("step"), F.lit(k).alias("fold"), "fit_rows", held.select(F.count(F.lit(1))).scalar().alias("held_rows"),
                             "pseudo_rows", "mean_target", "pseudo_weight")
            out = one if out is None else out.unionByName(one)
    return out


@query("k14_subset_train")
def k14_subset_train(spark, sf):
    """Train only on months 1-5 with encodings recomputed inside that subset (a period cell without other folds takes its cell's)."""
    tr, te = keyed_split(spark, sf)
    sub, te = pipeline.fill_missing(tr.where("month <= 5"), te)
    sub, te = pipeline.tier1_columns(sub), pipeline.tier1_columns(te)
    sub, te = encode.chained_encodings(sub, te, _CHAIN, _Y)
    sub = sub.withColumn("weight", fx.sample_weight("total_count"))
    feats = ["total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month",
             "log_total_count", "count_bin", "grid_te", "grid_period_te", "time_period"]
    return _fold_table(M.oof_train(sub, te, feats, _Y, params=_FAST, weight="weight"))


@query("k15_rescore")
def k15_rescore(spark, sf):
    """The same fold models score the test rows with full-train and with months-1-5 encodings, both columns swapped."""
    tr, te = tier2(spark, sf)
    feats = _feats(tr)
    res = M.oof_train(tr, None, feats, _Y, params=_FAST, files=True)
    own = encode.subset_encodings(tr.where("month <= 5"), te.select("row_id", "grid_id", "grid_period"), [("grid_id", 100.0, "grid_te"), ("grid_period", 150.0, "grid_period_te")], _Y)
    te5 = transform.swap_columns(te, own, "row_id", ["grid_te", "grid_period_te"])
    rows = []
    for name, frame in (("full_train", te), ("months_1_5", te5)):
        mean = M.mean_prediction(res.models, frame, feats)
        rows.append(mean.agg(F.avg("pred").alias("mean_pred"), F.count(F.lit(1)).alias("n")).withColumn("encoding", F.lit(name)))
    return rows[0].unionByName(rows[1]).select("encoding", r6("mean_pred"), "n")


#: Ranges of the search, its trials and how many run at once, and the rows it sees at most.
_SPACE = {"maxDepth": (2, 5), "stepSize": (0.03, 0.4, "log"), "subsamplingRate": (0.5, 1.0), "minInstancesPerNode": (1, 50)}
_TRIALS, _TOGETHER, _SEARCH_ROWS = 8, 4, 1_000_000


def _searched(tr, trials=_TRIALS):
    """Trials on months 1-5 (at most a million rows of them), three folds, weighted by log1p(count)."""
    sub = split.assign_fold(split.sample_n(tr.where("month <= 5"), _SEARCH_ROWS, seed=1), 3, seed=7, out="fold3")
    sub = stored(sub.withColumn("weight", fx.sample_weight("total_count")), "search_rows")
    return M.guided_search(sub, _feats(tr), _Y, _SPACE, trials, _TOGETHER, "fold3", (0, 1, 2), "weight", _FAST)


@query("k16_search")
def k16_search(spark, sf):
    """Every trial of the guided search with its parameters and mean OOF rho."""
    tr, _ = tier2(spark, sf)
    rows = [(i, str(sorted(p.items())), None if r is None else float(r)) for i, (p, r) in enumerate(_searched(tr))]
    return spark.createDataFrame(rows, "trial int, params string, mean_rho double")


@query("k16_retrain")
def k16_retrain(spark, sf):
    """The best trial's parameters fitted on all train rows: OOF prediction of every one of them."""
    tr, te = tier2(spark, sf)
    best = M.best_trial(_searched(tr))
    feats = _feats(tr)
    res = M.oof_train(tr.withColumn("weight", fx.sample_weight("total_count")), te, feats, _Y, params={**_FAST, **best}, weight="weight", files=True)
    return res.oof.select("row_id", "fold", r6("pred"))


#: Bins of a category and the smoothing of the means that order its values.
_BINS, _BIN_SMOOTH = 63, 10.0


@query("k17_categorical")
def k17_categorical(spark, sf):
    """Cell and period cell as categories: ordered by mean target in each fit side, at most 63 bins and one for unseen cells."""
    tr, te = tier2(spark, sf)
    cats = {"grid_id": "grid_bin", "grid_period": "period_bin"}
    tables = {c: stored(M.ordered_bins(tr, c, _Y, _BINS, out=b, smooth=_BIN_SMOOTH), f"bins_{c}") for c, b in cats.items()}

    def binned(k, df):
        for c, b in cats.items():
            df = M.with_bins(df, tables[c], k, c, _BINS, b)
        return df
    res = M.oof_train(tr, None, [*_feats(tr), *cats.values()], _Y, params={**_FAST, "maxBins": _BINS + 1}, per_fold=binned, files=True)
    return _fold_table(res).withColumn("cells", M.dense_index(tr, "grid_id").select(F.count(F.lit(1))).scalar())


@query("k17_dense_index", sql=S.keyed_cte() + """
SELECT grid_id, count(*) AS rows, row_number() OVER (ORDER BY count(*) DESC, grid_id) - 1 AS "index" FROM ktr GROUP BY grid_id""")
def k17_dense_index(spark, sf):
    """Every cell with its number, frequent ones first."""
    tr, _ = keyed_split(spark, sf)
    return M.dense_index(tr, "grid_id")


@query("k17_ordered_bins", sql=S.keyed_cte() + """
, f AS (SELECT DISTINCT fold FROM ktr), mu AS (SELECT avg(invalid_ratio) AS m FROM ktr)
, s AS (SELECT f.fold, g.grid_id, count(*) AS n, CAST((sum(g.invalid_ratio) + 10e0 * (SELECT m FROM mu)) / (count(*) + 10e0) AS FLOAT) AS v
  FROM f JOIN ktr g ON g.fold <> f.fold GROUP BY f.fold, g.grid_id)
, c AS (SELECT *, sum(n) OVER (PARTITION BY fold ORDER BY v, grid_id) AS cum, sum(n) OVER (PARTITION BY fold) AS total FROM s)
SELECT fold, grid_id, CAST(least(floor((cum - n / 2e0) / total * 63), 62) AS INTEGER) AS bin FROM c""")
def k17_ordered_bins(spark, sf):
    """The bin of every cell in the fit side of every fold."""
    tr, _ = keyed_split(spark, sf)
    return M.ordered_bins(tr, "grid_id", _Y, _BINS, smooth=_BIN_SMOOTH)


_K18_FEATS = ["total_count", "temp", "wind", "grid_te"]


@query("k18_standardise", sql=S.keyed_cte() + S.kfold_cte("e", "ktr", "grid_id", 30) + """
, g AS (SELECT t.fold, t.total_count, t.temp, coalesce(t.wind, (SELECT quantile_cont(wind, 0.5) FROM ktr)) AS wind, e.te AS grid_te
  FROM ktr t JOIN e ON t.grid_id = e.grid_id AND t.fold = e.fold)
, l AS (""" + " UNION ALL ".join(f"SELECT '{f}' AS feature, fold, CAST({f} AS DOUBLE) AS x FROM g" for f in _K18_FEATS) + """)
, m AS (SELECT feature, avg(x) AS mu, stddev_pop(x) AS sd FROM l WHERE fold <> 0 GROUP BY feature)
SELECT l.feature, round(avg((x - mu) / sd), 6) AS mean, round(stddev_pop((x - mu) / sd), 6) AS std
FROM l JOIN m ON l.feature = m.feature WHERE fold = 0 GROUP BY l.feature""")
def k18_standardise(spark, sf):
    """Moments of the held-out fold under the scaler fitted on the other folds."""
    tr, _ = tier2(spark, sf)
    feats = _K18_FEATS
    _, held = M.standardise(tr.where("fold != 0"), tr.where("fold = 0"), feats)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in feats]))
    long = held.select(pairs.alias("m")).select("m.*")  # one pass over the rows
    return long.groupBy("feature").agg(r6(F.avg("x"), "mean"), r6(F.stddev_pop("x"), "std"))


@query("k19_permutation_importance")
def k19_permutation_importance(spark, sf):
    tr, _ = tier2(spark, sf)
    feats = ["total_count", "temp", "wind", "hour", "grid_te", "grid_period_te"]
    fit, valid = tr.where("fold != 0"), tr.where("fold = 0")
    m = M._learner("gbt", _Y, _FAST).fit(M.assemble(fit, feats))
    return M.permutation_importance(m, valid.select("row_id", _Y, *feats), feats, _Y)


@query("k19_explain")
def k19_explain(spark, sf):
    """Shapley values of every feature for 10,000 train rows under the model of fold 0, with the base value and their sum, the prediction."""
    tr, _ = tier2(spark, sf)
    feats = _feats(tr)
    m = M.fit_files("gbt", tr.where("fold != 0"), feats, _Y, _FAST)
    out = trees.explain(m, split.sample_n(tr, 10_000, seed=42), feats)
    return out.select("row_id", r6("base"), *[r6(f"shap_{f}") for f in feats], r6("prediction"))


@query("k19_mean_impact")
def k19_mean_impact(spark, sf):
    """Features by the mean size of their Shapley values over the same rows."""
    tr, _ = tier2(spark, sf)
    feats = _feats(tr)
    m = M.fit_files("gbt", tr.where("fold != 0"), feats, _Y, _FAST)
    out = trees.explain(m, split.sample_n(tr, 10_000, seed=42), feats)
    long = out.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.abs(f"shap_{f}").alias("v")) for f in feats])).alias("x")).select("x.*")
    return long.groupBy("feature").agg(r6(F.avg("v"), "mean_impact"))


@query("k20_at_limit")
def k20_at_limit(spark, sf):
    """Folds whose best iteration came within ten of the limit."""
    tr, _ = tier2(spark, sf)
    res = _stopped(tr)
    n = M.at_limit(res.best_iters, _LIMIT)
    return spark.range(1).select(F.lit(len(res.models)).alias("folds"), F.lit(n).alias("at_limit"))


@query("g16_drift_importance")
def g16_drift_importance(spark, sf):
    """Train/test drift ranked by the adversarial models' importances (top 15)."""
    tr, te = tier2(spark, sf)
    _, _, models = M.adversarial_validation(tr, te, _ADV_FEATS, params=_FAST)
    imp = M.mean_importance(models, _ADV_FEATS)
    return imp.orderBy(F.col("importance").desc(), "feature").limit(15)
