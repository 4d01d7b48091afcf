"""Model jobs around MLlib learners.

The learner is ``GBTRegressor`` / ``GBTClassifier`` / ``RandomForestRegressor``;
what is reproduced is the job around it: fold loop, weights, OOF assembly,
test averaging, scoring by Spearman, comparisons. Folds are independent Spark
jobs submitted from a small thread pool, so the cluster runs them side by side -
as many at once as its storage memory holds the points of (:func:`side_by_side`).
Every prediction table is keyed by ``row_id`` - nothing relies on row order.

A fold is a unit of work: its OOF rows, its part of the test rows and its model are written to one folder, which
gets its name when all of them are there. A run that names the folder (``path``) finds the folds that an
earlier run finished, reads them, and fits the others (K2).
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import finer_splits, scratch_path, stored
from ..sources import io
from . import trees
from .stats import auc, spearman

DEFAULT_GBT = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42, "maxBins": 64}


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """``features`` as one dense vector of doubles; null is NaN. An array of columns is some 30 % cheaper a row than VectorAssembler's struct."""
    return df.withColumn(out, array_to_vector(trees.inputs(features)))


@dataclass
class OOFResult:
    oof: DataFrame                      # row_id, fold, pred
    test: DataFrame | None              # row_id, pred (mean over folds)
    score_col: str
    models: list = field(default_factory=list)
    best_iters: list = field(default_factory=list)    # trees kept by fold, under patience
    resumed: list = field(default_factory=list)       # folds read from an earlier run

    @cached_property
    def fold_scores(self) -> DataFrame:
        """fold, rho; ranked when first asked for."""
        return spearman(self.oof, "pred", self.score_col, by=["fold"])


_MODELS = {"gbt": GBTRegressionModel, "gbt_clf": GBTClassificationModel, "rf": RandomForestRegressionModel}


def _learner(kind: str, label: str, params: dict, weight: str | None = None):
    p = dict(DEFAULT_GBT)
    p.update(params or {})
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "pred"}
    if weight:
        common["weightCol"] = weight
    if kind == "rf":
        keep = {k: v for k, v in p.items() if k in ("maxDepth", "seed", "maxBins", "numTrees", "subsamplingRate")}
        return RandomForestRegressor(**common, **keep)
    p.pop("numTrees", None)
    if kind == "gbt_clf":
        return GBTClassifier(**common, **p).setProbabilityCol("prob").setRawPredictionCol("raw")
    return GBTRegressor(**common, **p)


def fit_files(kind: str, df: DataFrame, features: Sequence[str], label: str, params: dict | None = None, weight: str | None = None):
    """One model of rows of files, read in splits of bounded size, so a task's points don't grow with the table."""
    with finer_splits(df.sparkSession):
        return _learner(kind, label, params or {}, weight).fit(assemble(df, features))


def side_by_side(spark: SparkSession, rows: int, n_features: int, most: int, share: float = 0.6) -> int:
    """Fits over ``rows`` rows that run at once: as many as keep their points within ``share`` of the executors' storage memory, 1 to ``most``.

    MLlib holds a point a row (an integer a feature and some 130 bytes of objects and errors) in storage memory and reads it at every
    level of every tree; points that don't fit are written to disk and read back each time.
    """
    sc, env = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    driver = env.blockManager().blockManagerId()
    found = {(e.host(), e.port()): e.totalOnHeapStorageMemory() for e in sc.statusTracker().getExecutorInfos()}
    # the driver is listed too and holds no points, unless it is the only one
    each = [m for at, m in found.items() if at != (driver.host(), driver.port())] or list(found.values())
    return fits_at_once(sum(each), rows, n_features, most, share)


def fits_at_once(storage: int, rows: int, n_features: int, most: int, share: float = 0.6) -> int:
    """How many of ``most`` fits run at once in ``storage`` bytes, in rounds of about as many fits: a last fit alone leaves cores idle."""
    room = max(1, min(most, int(share * storage // max(1, rows * (4 * n_features + 130)))))
    return math.ceil(most / math.ceil(most / room))


def oof_train(train: DataFrame, test: DataFrame | None, features: Sequence[str], label: str,
              fold_col: str = "fold", folds: Sequence[int] = (0, 1, 2, 3, 4), kind: str = "gbt",
              params: dict | None = None, weight: str | None = None, patience: int | None = None,
              score_col: str | None = None, parallel: int = 5, fit_filter=None, extra_fit: DataFrame | None = None,
              per_fold: Callable[[int, DataFrame], DataFrame] | None = None, path: str | None = None, files: bool = False) -> OOFResult:
    """K2-K5: one model per fold; OOF prediction for every train row, mean-of-folds for test.

    ``patience`` (K3): the held-out fold's squared error is taken after every tree; the model keeps the trees up to the
    best one found before so many in a row brought nothing, and predicts with those alone.
    ``weight`` weights training rows only (K4). ``score_col`` is the column scored against (the raw target for K5).
    ``fit_filter(fold) -> Column`` removes rows from the fit side only (I10); ``extra_fit`` rows join every fit side and
    no held-out fold (I8). ``per_fold(fold, df)`` adds columns that only the fit side of a fold may shape (K17).
    ``path``: a folder that keeps finished folds with their models; folds found there aren't fitted again.
    ``files``: ``train`` and ``test`` are rows of files with columns computed row by row. They are read again at each pass and never
    cached (assembled rows take several times the files' bytes), in splits of bounded size, so a task's points don't grow with the table.
    """
    score_col = score_col or label
    spark = train.sparkSession
    own = per_fold or (lambda k, df: df)
    base, keep = path or scratch_path(spark, "folds"), path is not None
    tr, te, more = train, test, None
    if not per_fold:
        # on disk: the learners' own points need the storage memory, and rows cached beside them would only push them out
        needed = list(dict.fromkeys(["row_id", fold_col, "features", label, score_col, *([weight] if weight else []), *(features if patience is not None else [])]))
        kept = (lambda df: df) if files else (lambda df: df.persist(StorageLevel.DISK_ONLY))
        narrow = lambda df, cols: kept(assemble(df, features).select(*cols))
        tr = narrow(train, needed if fit_filter is None else ["*"])
        te = None if test is None else narrow(test, ["row_id", "features"])
        more = None if extra_fit is None else assemble(extra_fit, features)
    together = side_by_side(spark, sum(df.count() for df in (tr, extra_fit) if df is not None), len(features), parallel)
    ready = (lambda k, df: assemble(own(k, df), features)) if per_fold else (lambda k, df: df)

    def run(k: int):
        home = f"{base}/fold-{k}"
        if io.exists(spark, home):
            model = _MODELS[kind].load(f"{home}/model") if keep else None
            return model, True
        fit = tr.where(F.col(fold_col) != k)
        if fit_filter is not None:
            fit = fit.where(fit_filter(k))
        fit, valid = ready(k, fit), ready(k, tr.where(F.col(fold_col) == k))
        used = [c for c in ("features", label, weight) if c]
        fit = fit.select(*used)
        if extra_fit is not None:
            fit = fit.unionByName((more if more is not None else ready(k, extra_fit)).select(*used))
        model = _learner(kind, label, params or {}, weight).fit(fit)
        if patience is not None:
            losses = trees.staged_loss(trees.read_trees(model, spark), valid, features, label)
            model = trees.truncated(model, trees.best_prefix(losses, patience), spark)
        # classifiers are scored on P(class 1), regressors on the prediction
        score = vector_to_array("prob")[1] if kind == "gbt_clf" else F.col("pred").cast("double")
        parts = {"oof": model.transform(valid).select("row_id", F.lit(k).alias("fold"), score.alias("pred"), score_col)}
        if te is not None:
            parts["test"] = model.transform(ready(k, te)).select("row_id", score.alias("pred"))
        io.commit(spark, home, parts, model if keep else None)
        return model, False

    with finer_splits(spark) if files else nullcontext(), ThreadPoolExecutor(max_workers=together) as pool:
        done = list(pool.map(run, folds))
    for frame in (tr, te):
        if frame is not None and not per_fold and not files:
            frame.unpersist()
    oof, tests = (io.read_parts(spark, [f"{base}/fold-{k}/{part}" for k in folds]) if part == "oof" or te is not None else None for part in ("oof", "test"))
    test_mean = None
    if tests is not None:
        test_mean = tests.groupBy("row_id").agg(F.avg("pred").alias("pred"), F.count(F.lit(1)).alias("n_folds"))
    models = [m for m, _ in done]
    return OOFResult(oof.select("row_id", "fold", "pred", score_col), test_mean, score_col, models,
                     [m.getNumTrees for m in models] if models[0] is not None else [], [k for k, (_, old) in zip(folds, done) if old])


def rf_baseline(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 10, seed: int = 42) -> DataFrame:
    """K1: forest on the raw features, scored in-sample by Spearman."""
    d = assemble(df, features)
    m = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="pred",
                              numTrees=num_trees, seed=seed, maxDepth=5).fit(d)
    return spearman(m.transform(d), "pred", label).withColumn("num_trees", F.lit(num_trees))


def mean_importance(models: list, features: Sequence[str]) -> DataFrame:
    """K7: feature importances averaged over the fold models (split-gain based)."""
    spark = SparkSession.getActiveSession()
    rows = []
    for m in models:
        imp = m.featureImportances.toArray()
        rows.extend((f, float(v)) for f, v in zip(features, imp))
    return spark.createDataFrame(rows, "feature string, importance double").groupBy("feature") \
        .agg(F.avg("importance").alias("importance"))


def adversarial_validation(train: DataFrame, test: DataFrame, features: Sequence[str], folds: int = 5,
                           params: dict | None = None) -> tuple[DataFrame, DataFrame, list]:
    """K8: classify train vs test (train down-sampled to the test size), stratified folds,
    OOF probability, AUC per fold. Returns (fold AUCs, OOF probabilities, models)."""
    from .split import assign_stratified_fold, balance, label_sources
    cols = ["row_id", *features]
    bal = balance(train, test)
    lab = label_sources(bal, test, cols, "is_test")
    lab = assign_stratified_fold(lab, "is_test", folds)
    res = oof_train(lab, None, features, "is_test", kind="gbt_clf", params=params, folds=range(folds))
    oof = res.oof.withColumnRenamed("is_test", "label")
    fold_auc = auc(oof, "pred", "label", by=["fold"])
    return fold_auc, oof, res.models


def test_likeness(model, df: DataFrame, features: Sequence[str], out: str = "p_test") -> DataFrame:
    """K9: probability that a train row looks like a test row (final adversarial model)."""
    t = model.transform(assemble(df, features))
    return t.withColumn(out, vector_to_array("prob")[1]).drop("features", "prob", "raw", "pred")


def mean_prediction(models: Sequence, df: DataFrame, features: Sequence[str], key: str = "row_id") -> DataFrame:
    """``key``, pred: mean prediction of all models. They score a row side by side, so rows are read, assembled and grouped once, not once a model."""
    out = assemble(df, features).select(key, "features")
    for i, m in enumerate(models):
        out = m.transform(out).withColumnRenamed(m.getPredictionCol(), f"_zk_p{i}")
    own = sum((F.col(f"_zk_p{i}") for i in range(1, len(models))), F.col("_zk_p0")) / F.lit(float(len(models)))
    return out.groupBy(key).agg(F.avg(own).alias("pred"))


def fit_score(fit: DataFrame, valid: DataFrame, features: Sequence[str], label: str, params: dict | None = None,
              weight: str | None = None) -> DataFrame:
    """K10 building block: one fit, Spearman on the validation rows. Files are read in bounded splits, as by folds."""
    m = fit_files("gbt", fit, features, label, params, weight)
    p = m.transform(assemble(valid, features))
    return spearman(p, "pred", label)


# ---- guided search (K16) -------------------------------------------------------------------------------------

def _unit(bounds: tuple, value: float) -> float:
    """Place of a value in its range, 0 to 1; ranges (low, high) or (low, high, 'log')."""
    low, high = map(math.log, bounds[:2]) if "log" in bounds else map(float, bounds[:2])
    value = math.log(value) if "log" in bounds else float(value)
    return (value - low) / (high - low) if high > low else 0.0


def _value(bounds: tuple, at: float):
    low, high = map(math.log, bounds[:2]) if "log" in bounds else map(float, bounds[:2])
    x = low + min(max(at, 0.0), 1.0) * (high - low)
    x = math.exp(x) if "log" in bounds else x
    if all(isinstance(b, int) for b in bounds[:2]):
        return min(max(int(round(x)), bounds[0]), bounds[1])
    return round(min(max(x, bounds[0]), bounds[1]), 6)


def _density(at: float, seen: Sequence[float]) -> float:
    """A normal kernel on every value seen and a flat part of weight 1, on 0 to 1."""
    width = max(0.08, 1.0 / (1 + len(seen)))
    mass = lambda c: 0.5 * (math.erf((1 - c) / width / math.sqrt(2)) + math.erf(c / width / math.sqrt(2)))
    kernels = sum(math.exp(-((at - c) / width) ** 2 / 2) / (width * math.sqrt(2 * math.pi) * mass(c)) for c in seen)
    return (1.0 + kernels) / (1 + len(seen))


def propose(space: dict, trials: Sequence[tuple[dict, float]], rng: random.Random, startup: int = 4, good_share: float = 0.25, draws: int = 24) -> dict:
    """Parameters of the next trial: at random before ``startup`` scores are known; then, for each parameter, the draw from the density of the
    good trials (the best ``good_share``) at which it exceeds the density of the others most."""
    scored = sorted((t for t in trials if t[1] is not None), key=lambda t: -t[1])
    out = {}
    n_good = max(1, math.ceil(good_share * len(scored)))
    for name, bounds in space.items():
        if isinstance(bounds, list):  # choices
            if len(scored) < startup:
                out[name] = rng.choice(bounds)
                continue
            share = lambda c, part: (1 + sum(t[0][name] == c for t in part)) / (len(bounds) + len(part))
            out[name] = max(bounds, key=lambda c: share(c, scored[:n_good]) / share(c, scored[n_good:]) * (1 + 1e-3 * rng.random()))
            continue
        if len(scored) < startup:
            out[name] = _value(bounds, rng.random())
            continue
        good, bad = ([_unit(bounds, t[0][name]) for t in part] for part in (scored[:n_good], scored[n_good:]))
        width = max(0.08, 1.0 / (1 + len(good)))

        def draw() -> float:
            centre = rng.choice([None, *good])
            return rng.random() if centre is None else min(max(rng.gauss(centre, width), 0.0), 1.0)
        out[name] = _value(bounds, max((draw() for _ in range(draws)), key=lambda a: _density(a, good) / _density(a, bad)))
    return out


def guided_search(train: DataFrame, features: Sequence[str], label: str, space: dict, n_trials: int = 12, together: int = 4,
                  fold_col: str = "fold", folds: Sequence[int] = (0, 1, 2), weight: str | None = None, params: dict | None = None,
                  seed: int = 42) -> list[tuple[dict, float]]:
    """(parameters, mean OOF rho) of every trial, in order. Trials run ``together`` at a time as concurrent jobs; each such
    round is proposed from the scores of all rounds before, so results don't depend on which job ends first.

    ``space``: name -> (low, high), (low, high, 'log') or a list of choices. The driver holds a row a trial.
    """
    rng, done = random.Random(seed), []

    def score(own: dict) -> float | None:
        res = oof_train(train, None, features, label, fold_col, folds, params={**(params or {}), **own}, weight=weight, parallel=len(folds))
        return res.fold_scores.agg(F.avg("rho")).first()[0]

    startup = max(together, min(4, n_trials))
    at_once = side_by_side(train.sparkSession, train.count(), len(features), together * len(folds))
    while len(done) < n_trials:
        batch = [propose(space, done, rng, startup) for _ in range(min(together, n_trials - len(done)))]
        with ThreadPoolExecutor(max_workers=max(1, at_once // len(folds))) as pool:
            done += list(zip(batch, pool.map(score, batch)))
    return done


def best_trial(trials: Sequence[tuple[dict, float]]) -> dict:
    """Parameters of the best score, the first of equal ones."""
    scored = [t for t in trials if t[1] is not None]
    if not scored:
        raise ValueError("no trial has a score")
    return max(scored, key=lambda t: t[1])[0]


# ---- categories (K17) ----------------------------------------------------------------------------------------

def dense_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """(col, rows, out): every distinct value with its number from 0, frequent ones first, equal counts by value. Null is no value.

    Values are counted, range-partitioned by count, and numbered by running offsets; none passes through the driver.
    """
    from .ranks import row_position
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    placed = row_position(counts.withColumn("_zk_less", -F.col("rows")), ["_zk_less", col], out=out)
    return placed.select(col, "rows", (F.col(out) - 1).cast("long").alias(out))


def ordered_bins(train: DataFrame, col: str, y: str, bins: int, fold_col: str = "fold", folds: Sequence[int] = (0, 1, 2, 3, 4), out: str = "bin",
                 smooth: float = 10.0) -> DataFrame:
    """(fold, col, out) for the fit side of every fold: values ordered by their smoothed mean target there and cut to ``bins`` bins of about as
    many rows, numbered from 0. Whatever the number of values, a learner sees at most ``bins`` and one for unseen values.

    Sums by (value, fold) are one pass over the rows; a fold's sums are those of all less its own. Values order by running
    totals within each fold, so none is one task's work.
    """
    from .encode import fold_stats
    from .ranks import running_totals
    sums = fold_stats(train.where(F.col(col).isNotNull()), col, y, fold_col)
    sides = F.explode(F.array(*[F.lit(int(k)) for k in folds])).alias("_zk_side")
    side = sums.select(col, "_s", "_n", fold_col, sides).where(F.col(fold_col) != F.col("_zk_side"))
    side = side.groupBy("_zk_side", col).agg(F.sum("_s").alias("s"), F.sum("_n").alias("n")).where("n > 0")
    mu = train.select(F.avg(y)).scalar()
    side = side.withColumn("_zk_mean", ((F.col("s") + F.lit(smooth) * mu) / (F.col("n") + F.lit(smooth))).cast("float"))
    cum = running_totals(side, ["_zk_mean", col], ["n"], ["_zk_side"])
    middle = (F.col("n_cum") - F.col("n") / 2) / F.col("n_all")
    return cum.select(F.col("_zk_side").alias("fold"), col, F.least(F.floor(middle * F.lit(bins)), F.lit(bins - 1)).cast("int").alias(out))


def with_bins(df: DataFrame, table: DataFrame, fold: int, col: str, bins: int, out: str = "bin") -> DataFrame:
    """``df`` with the bin of ``col`` in the fit side of ``fold``; ``bins`` (a bin of its own) for values not seen there and null."""
    own = table.where(F.col("fold") == fold).select(F.col(col), F.col(out).alias("_zk_bin"))
    return df.join(own, on=col, how="left").withColumn(out, F.coalesce("_zk_bin", F.lit(bins)).cast("double")).drop("_zk_bin")


def standardise(fit: DataFrame, apply: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with ``features`` scaled by the mean and deviation (ddof 0) of ``fit``; a constant one becomes 0."""
    from .lookup import with_scalars
    moments = fit.agg(*[x for f in features for x in (F.avg(f).alias(f"_zk_m_{f}"), F.stddev_pop(f).alias(f"_zk_s_{f}"))])

    def scaled(df: DataFrame) -> DataFrame:
        out = with_scalars(df, moments)
        out = out.withColumns({f: F.when(F.col(f).isNotNull(), F.coalesce(
            F.try_divide(F.col(f) - F.col(f"_zk_m_{f}"), F.col(f"_zk_s_{f}")), F.lit(0.0))) for f in features})
        return out.drop(*moments.columns)

    return scaled(fit), scaled(apply)


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str, key: str = "row_id") -> DataFrame:
    """Spearman drop when one column is permuted.

    The row at position ``i`` in key order takes the value of the row at
    position ``i`` in hash order; both positions come from the distributed
    running count, and the re-pairing is two equi joins, made once for all features.
    """
    from .ranks import row_position
    from ..functions.features import mix32
    base = spearman(model.transform(assemble(df, features)), "pred", label).select("rho").collect()[0][0]
    pa = row_position(df.select(key), [key], out="_zk_i")
    pb = row_position(df.select(F.col(key).alias("_zk_src"), mix32(key, 99).alias("_zk_h")), ["_zk_h", "_zk_src"], out="_zk_i")
    mapping = pa.join(pb.select("_zk_i", "_zk_src"), on="_zk_i").select(key, "_zk_src")
    donor = df.select(F.col(key).alias("_zk_src"), *[F.col(f).alias(f"_zk_v_{f}") for f in features])
    paired = stored(df.join(mapping, on=key).join(donor, on="_zk_src").drop("_zk_src"), "permuted")  # every feature reads it
    rows = []
    for f in features:
        perm = paired.withColumn(f, F.col(f"_zk_v_{f}"))
        r = spearman(model.transform(assemble(perm, features)), "pred", label).select("rho").collect()[0][0]
        rows.append((f, float(base - r) if r is not None and base is not None else None))
    return df.sparkSession.createDataFrame(rows, "feature string, rho_drop double")


def at_limit(best_iters: Sequence[int], max_iter: int, within: int = 10) -> int:
    """Number of folds whose best iteration lies within ``within`` of the limit: more trees might have helped."""
    return sum(1 for b in best_iters if b > 0 and b >= max_iter - within)
