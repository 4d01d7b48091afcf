"""Feature steps over large tables: known sizes, one pass."""

import numpy as np
from pyspark.sql import functions as F

from zonekit.operators import transform
from zonekit.plans import common, pipeline, q_models


def test_cell_statistics_are_of_known_size(spark, monkeypatch):
    """cell statistics are written, so that a small table of them is broadcast and the rows aren't shuffled; their sizes are read from it."""
    names, keep = [], pipeline.stored
    monkeypatch.setattr(pipeline, "stored", lambda df, name: names.append(name) or keep(df, name))
    tr, te = common.keyed_split(spark, "/root/testdata/sf0.001")
    got, _ = pipeline.features(tr, te)
    assert names == ["cell_stats"] and got.count() == tr.count()
    sizes = [r[0] for r in tr.groupBy("grid_id").count().select("count").collect()]
    stats = transform.cell_stats(tr, "grid_id", "invalid_ratio").select(F.col("grid_sample_count").alias("_zk_sz"))
    one = transform.global_stats(tr, "grid_id", "invalid_ratio", sizes=stats)["grid_sample_count"]
    assert spark.range(1).select(one).first()[0] == np.median(sizes)


def test_standardise_reads_rows_once(spark, tmp_path, monkeypatch, capsys):
    """the four features' moments are one pass over the held-out rows (and one for the scaler)."""
    r = np.random.default_rng(5)
    rows = [(i % 5, i, float(a), float(b), float(a > 0.5)) for i, (a, b) in enumerate(r.random((600, 2)))]
    spark.createDataFrame(rows, "fold int, row_id long, a double, b double, y double").write.parquet(str(tmp_path / "train"))
    tr = spark.read.parquet(str(tmp_path / "train")).select("fold", F.col("row_id").cast("int").alias("total_count"), F.col("a").alias("temp"), F.col("b").alias("wind"), F.col("y").alias("grid_te"))
    monkeypatch.setattr(q_models, "tier2", lambda *a: (tr, tr))
    out = q_models.k18_standardise(spark, "")
    out.explain()
    assert capsys.readouterr().out.count("IsNotNull(fold), EqualTo(fold,0)") == 1
    p = tr.toPandas()
    for name, mean, std in out.select("feature", "mean", "std").collect():
        fit, held = (p[p.fold != 0][name].astype(float), p[p.fold == 0][name].astype(float))
        z = (held - fit.mean()) / fit.std(ddof=0)
        assert abs(z.mean() - mean) < 2e-6 and abs(z.std(ddof=0) - std) < 2e-6
