"""Fold assignment, sampling and set operations.

Folds are pure functions of the row key (no shuffle, same on every rerun and
after executor loss). Exact samples and stratified folds need positions in a
hash order; they come from the distributed running count in
:mod:`zonekit.operators.ranks`, never from ``orderBy().limit()`` on a large n
or a window without partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import fold_of, mix32
from .ranks import row_position


def assign_fold(df: DataFrame, k: int = 5, key: str = "row_id", seed: int = 0, out: str = "fold") -> DataFrame:
    """Shuffled K-fold membership from a hash of the key (same folds for every model)."""
    return df.withColumn(out, fold_of(key, k, seed))


def assign_stratified_fold(df: DataFrame, label: str, k: int = 5, key: str = "row_id", seed: int = 0,
                           out: str = "fold") -> DataFrame:
    """Stratified folds: inside each label, rows in hash order go to folds round-robin,
    so every fold holds ``n_label / k`` (+-1) rows of every label."""
    d = df.withColumn("_zk_h", mix32(key, seed))
    p = row_position(d, ["_zk_h", key], by=[label], out="_zk_pos")
    return p.withColumn(out, ((F.col("_zk_pos") - 1) % F.lit(k)).cast("int")).drop("_zk_h", "_zk_pos")


def sample_n(df: DataFrame, n, key: str = "row_id", seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the first ``n`` in hash order.

    ``n`` may be an int or a Column (for example a scalar subquery). Deterministic. Rows are first counted by the upper half
    of their hash (at most 65,537 counts); only those up to the slot that holds the last row wanted are put in order.
    """
    limit = n if isinstance(n, Column) else F.lit(int(n))
    d = df.withColumn("_zk_h", mix32(key, seed))
    slot = F.coalesce(F.floor(F.col("_zk_h") / F.lit(65536)), F.lit(-1))  # a null key has a null hash, and comes first
    counts = d.groupBy(slot.alias("_zk_slot")).agg(F.count(F.lit(1)).alias("_zk_n"))
    before = counts.select("_zk_slot", (F.sum("_zk_n").over(Window.orderBy("_zk_slot")) - F.col("_zk_n")).alias("_zk_before"))
    last = before.where(F.col("_zk_before") < limit).agg(F.max("_zk_slot")).scalar()
    p = row_position(d.where(slot <= last), ["_zk_h", key], out="_zk_pos")
    return p.where(F.col("_zk_pos") <= limit).drop("_zk_h", "_zk_pos")


def sample_stratum(df: DataFrame, cond: Column, n: int, key: str = "row_id", seed: int = 0) -> DataFrame:
    """I4: ``n`` rows from the rows meeting ``cond`` (all of them when fewer)."""
    return sample_n(df.where(cond), n, key, seed)


def balance(train: DataFrame, test: DataFrame, key: str = "row_id", seed: int = 0) -> DataFrame:
    """Down-sample ``train`` to the size of ``test``."""
    # all rows are put in order: a learner's subsampling follows the partitions of this sample, which sample_n lays out otherwise
    p = row_position(train.withColumn("_zk_h", mix32(key, seed)), ["_zk_h", key], out="_zk_pos")
    return p.where(F.col("_zk_pos") <= test.select(F.count(F.lit(1))).scalar()).drop("_zk_h", "_zk_pos")


def temporal_split(df: DataFrame, fit_months: Sequence[int] = (1, 2, 3, 4), valid_months: Sequence[int] = (5,),
                   month: str = "month") -> tuple[DataFrame, DataFrame]:
    """Fit on some months, validate on later ones."""
    return df.where(F.col(month).isin(*fit_months)), df.where(F.col(month).isin(*valid_months))


def label_sources(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str = "is_test") -> DataFrame:
    """Union of train (0) and test (1) with a source label."""
    return train.select(*cols).withColumn(label, F.lit(0)) \
        .unionByName(test.select(*cols).withColumn(label, F.lit(1)))


def augment_fold(train: DataFrame, pseudo: DataFrame, fold: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """I8: (fit, valid) for one fold: pseudo rows join the fit side only."""
    fit = train.where(F.col(fold_col) != fold).withColumn("is_pseudo", F.lit(0)) \
        .unionByName(pseudo.withColumn("is_pseudo", F.lit(1)), allowMissingColumns=True)
    valid = train.where(F.col(fold_col) == fold)
    return fit, valid


def pseudo_labels(test: DataFrame, preds: Sequence[str], l1: float = 0.02, l2: float = 0.10,
                  w1: float = 0.7, w2: float = 0.3) -> DataFrame:
    """Layered pseudo set: label = mean of the models' (clipped) predictions;
    layer 1 (confident) weight ``w1``, layer 2 weight ``w2``; other rows dropped."""
    from ..functions.features import clip01
    from .transform import confidence_layer
    mean = sum((clip01(p) for p in preds), F.lit(0.0)) / F.lit(float(len(preds)))
    d = test.withColumn("pseudo_y", mean).withColumn("layer", confidence_layer("pseudo_y", l1, l2))
    return d.where(F.col("layer").isNotNull()) \
        .withColumn("weight", F.when(F.col("layer") == 1, F.lit(w1)).otherwise(F.lit(w2)))


def exclude_noise_train_only(train: DataFrame, noise: Column, fold: int, fold_col: str = "fold"):
    """(fit, valid): noise rows leave the fit side; validation keeps every row."""
    fit = train.where((F.col(fold_col) != fold) & ~noise)
    valid = train.where(F.col(fold_col) == fold)
    return fit, valid
