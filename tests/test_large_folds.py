"""Fold jobs over large files: nothing cached, bounded splits and files, scores on request."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonekit import session
from zonekit.operators import models as M
from zonekit.plans import common


X = ["a", "b"]

@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """600 observations in four files."""
    r = np.random.default_rng(5)
    rows = [(i, i % 5, float(a), float(b), float(a > 0.5)) for i, (a, b) in enumerate(r.random((600, 2)))]
    path = str(tmp_path_factory.mktemp("rows") / "train")
    spark.createDataFrame(rows, "row_id long, fold int, a double, b double, y double").repartition(4, "row_id").write.parquet(path)
    return spark.read.parquet(path)


def test_file_rows_are_not_cached(files, monkeypatch):
    """Rows of files are read again; the predictions are those of cached rows."""
    held = []
    persist = type(files).persist
    monkeypatch.setattr(type(files), "persist", lambda df, *level: held.append(df) or persist(df, *level))
    run = lambda **own: sorted(map(tuple, M.oof_train(files, files, X, "y", params={"maxIter": 2, "maxDepth": 2}, **own).oof.collect()))
    plain = run(files=True)
    assert not held and len(plain) == 600
    assert run() == plain and len(held) == 2


def test_splits_are_bounded(spark, files, monkeypatch):
    """rows of files come in bounded splits inside, nested users or not; the session keeps its setting."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(session, "_SPLIT", 4096)
    read = lambda: spark.read.parquet(files.inputFiles()[0].rsplit("/", 1)[0]).rdd.getNumPartitions()
    with session.finer_splits(spark):
        with session.finer_splits(spark):
            assert read() >= 4
        assert session._bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 4096
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert [session._bytes(v) for v in ("134217728b", "128MB", "1g", "7")] == [128 << 20, 128 << 20, 1 << 30, 7]


def test_scores_are_ranked_when_asked_for(files, monkeypatch):
    """a job that wants test rows alone ranks no out-of-fold prediction."""
    ranked, rank = [], M.spearman
    monkeypatch.setattr(M, "spearman", lambda *a, **k: ranked.append(1) or rank(*a, **k))
    res = M.oof_train(files, files, X, "y", params={"maxIter": 1, "maxDepth": 2}, files=True)
    assert res.test.count() == 600 and not ranked
    assert res.fold_scores.count() == 5 and res.fold_scores is res.fold_scores and ranked == [1]


def test_tier2_files_hold_bounded_rows(spark, monkeypatch):
    """Feature files can be dealt to many tasks."""
    monkeypatch.setattr(common, "_FILE_ROWS", 1000)
    monkeypatch.setattr(common, "_TIER_VERSION", "test-files")
    tr, te = common.tier2(spark, "/root/testdata/sf0.001")
    per_file = [r[0] for r in tr.groupBy(F.input_file_name()).agg(F.count(F.lit(1))).select("count(1)").collect()]
    assert max(per_file) <= 1000 and sum(per_file) == tr.count() > 5000 and te.count()
