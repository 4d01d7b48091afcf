"""Fold jobs over joined rows: what a pass reads lies in files, and models score a row once."""

import pytest
from pyspark.sql import functions as F

from zonekit import session
from zonekit.operators import models as M, ranks
from zonekit.plans import q_models

SF = "/root/testdata/sf0.001"


def plain(df) -> bool:
    """Whether ``df`` is a scan of files with columns computed row by row."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Join" not in plan and "Aggregate" not in plan and "UDF" not in plan and bool(df.inputFiles())


@pytest.fixture
def jobs(spark, monkeypatch):
    """Calls of oof_train, answered by the share of an id as prediction."""
    calls = []

    def stub(train, test, features, label, extra_fit=None, score_col=None, files=False, **own):
        calls.append((train, extra_fit, files))
        pred = (F.pmod(F.hash("row_id"), F.lit(1000)) / 1000.0).alias("pred")
        score = score_col or label
        oof = train.select("row_id", "fold", pred, score)
        return M.OOFResult(oof, None if test is None else test.select("row_id", pred, F.lit(5).alias("n_folds")), score)
    monkeypatch.setattr(M, "oof_train", stub)
    return calls


@pytest.mark.parametrize("name,least", [("k5_rank_target", 1), ("k12_noise_strategies", 4), ("k13_pseudo_curriculum", 4)])
def test_folds_read_files(spark, jobs, name, least):
    """joins before the folds are made once and written, also the pseudo rows; nothing is cached beside the files."""
    getattr(q_models, name)(spark, SF).collect()
    assert len(jobs) >= least
    assert all(files and plain(train) and (extra is None or plain(extra)) for train, extra, files in jobs)


def test_written_ranks_leave_rows_in_place(spark):
    """rows are not dealt by the value that is ranked, which many share; the ranks are the same."""
    d = spark.range(4000).repartition(5).select("id", F.when(F.col("id") % 9 < 8, F.col("id") % 3).cast("double").alias("y"))
    plain_, written = (ranks.average_rank(d, "y", normalise=True, written=w) for w in (False, True))
    assert sorted(map(str, written.collect())) == sorted(map(str, plain_.collect()))
    assert "Broadcast" in written._jdf.queryExecution().executedPlan().toString()


def test_classifier_scores_once(spark, jobs, monkeypatch):
    """the weights of k11 are columns of files, not a classifier run by every pass."""
    monkeypatch.setattr(q_models, "_FAST", {"maxIter": 1, "maxDepth": 1})
    q_models.k11_av_weighted(spark, SF).collect()
    assert len(jobs) == 2 and all(files and plain(train) for train, _, files in jobs)


def test_mean_prediction(spark):
    """models score a row side by side; rows of one key share the mean."""
    rows = [(i % 50, float(i % 7), float(i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, a double, y double")
    fits = [M._learner("gbt", "y", {"maxIter": 1, "maxDepth": 1, "seed": s}).fit(M.assemble(df, ["a"])) for s in (1, 2, 3)]
    got = {r.row_id: r.pred for r in M.mean_prediction(fits, df, ["a"]).collect()}
    each = [p for m in fits for p in m.transform(M.assemble(df, ["a"])).select("row_id", "pred").collect()]
    for k in range(50):
        own = [r.pred for r in each if r.row_id == k]
        assert abs(got[k] - sum(own) / len(own)) < 1e-12
    plan = M.mean_prediction(fits, df, ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and len(got) == 50


def test_single_fits_read_bounded_splits(spark, monkeypatch):
    """fits outside fold jobs deal the feature files in bounded splits too."""
    seen, learner = [], M._learner

    def watched(*a, **k):
        seen.append(session._bytes(spark.conf.get(session._SPLIT_CONF)) <= session._SPLIT)
        return learner(*a, **k)
    monkeypatch.setattr(M, "_learner", watched)
    monkeypatch.setattr(q_models, "_FAST", {"maxIter": 1, "maxDepth": 1})
    for name in ("k19_explain", "k19_mean_impact", "k10_temporal_validation"):
        getattr(q_models, name)(spark, SF)
    assert len(seen) == 8 and all(seen)
