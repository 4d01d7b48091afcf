"""Smoothed target encoding, full-train and leakage-safe K-fold (H1-H8).

``enc(k) = (n_k * mean_k + s * mu) / (n_k + s)``, ``mu`` the train mean.

K-fold: sums per ``(key, fold)`` (partial aggregation on the map side, so a hot
key costs one row per map task) are written once; mean, totals per key and test maps come from that small table,
the own fold is subtracted, and the result joined back on ``(key, fold)``.
The per-fold loop of the reference (one groupBy per fold) becomes one shuffle.
A hot key is already split ``k`` ways by the fold in the join key; AQE's skew
join splits further. The encoding table is never broadcast blindly: AQE
broadcasts it only when its measured size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def global_mean(df: DataFrame, y: str) -> Column:
    """``mu`` as a scalar subquery (one value, never a row-level collect)."""
    return df.select(F.avg(F.col(y))).scalar()


def smooth_expr(s: Column, n: Column, smooth: float, mu: Column) -> Column:
    return (s + F.lit(float(smooth)) * mu) / (n + F.lit(float(smooth)))


def as_stored(c: Column) -> Column:
    """Encodings are stored at float32 precision (as the reference stores them).

    This also makes equal encodings compare equal whatever order the engine
    summed in, so later ranks see the same ties on every run.
    """
    return c.cast("float").cast("double")


def fit_encoding(train: DataFrame, key: str, y: str = "invalid_ratio", smooth: float = 30.0,
                 mu: Column | None = None, out: str = "te") -> DataFrame:
    """H1: encoding map ``(key, te, n)`` from all of ``train``.

    Keys that are null are dropped, as a map lookup can never hit them.
    """
    mu = global_mean(train, y) if mu is None else mu
    stats = (train.where(F.col(key).isNotNull())
             .groupBy(key).agg(F.sum(y).alias("_s"), F.count(y).alias("n")))
    return stats.select(key, as_stored(smooth_expr(F.col("_s"), F.col("n"), smooth, mu)).alias(out), "n")


def mean_of(stats: DataFrame) -> Column:
    """``mu`` from the sums of a :func:`fold_stats` table: the rows aren't read again."""
    return stats.select(F.try_divide(F.sum("_s"), F.sum("_n"))).scalar()


def full_table(stats: DataFrame, key: str, smooth: float, mu: Column, out: str = "te") -> DataFrame:
    """H1 from the sums of a :func:`fold_stats` table: (key, out, n) over all folds."""
    total = stats.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("n"))
    return total.select(key, as_stored(smooth_expr(F.col("_s"), F.col("n"), smooth, mu)).alias(out), "n")


def apply_encoding(df: DataFrame, enc: DataFrame, key: str, out: str, te_col: str = "te",
                   fill: Column | None = None) -> DataFrame:
    """D1 + D6: left lookup of ``key`` in ``enc``; unseen keys -> ``fill`` (or null)."""
    e = enc.select(F.col(key), F.col(te_col).alias("_zk_te"))
    joined = df.join(e, on=key, how="left")
    val = F.col("_zk_te") if fill is None else F.coalesce(F.col("_zk_te"), fill)
    return joined.withColumn(out, val).drop("_zk_te")


def fold_stats(train: DataFrame, key: str, y: str, fold: str = "fold") -> DataFrame:
    """Sums and counts per ``(key, fold)`` - the only pass over the rows."""
    return train.groupBy(key, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))


def stored_stats(train: DataFrame, keys: Sequence[str], y: str, fold: str = "fold") -> DataFrame:
    """Sums and counts per ``(keys, fold)``, written once: as many rows as groups. Mean, fold tables and full tables all
    come from it, so encoding reads the rows twice in all, however many tables it takes. For several keys that
    nest (a cell and its periods); the sums of one key are those of its groups."""
    return stored(train.groupBy(*keys, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n")), "fold_stats")


def of_key(stats: DataFrame, key: str, fold: str = "fold") -> DataFrame:
    return stats.groupBy(key, fold).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))


def kfold_table(train: DataFrame, key: str, y: str = "invalid_ratio", fold: str = "fold",
                smooth: float = 30.0, mu: Column | None = None, out: str = "te", absent: str = "mean",
                stats: DataFrame | None = None) -> DataFrame:
    """H2 encoding table ``(key, fold, te)``: statistics of all other folds.

    A key absent from every other fold gets ``mu``, with ``absent='null'`` no value, for a fallback of the caller's.
    """
    stats = stored_stats(train, [key], y, fold) if stats is None else stats
    mu = mean_of(stats) if mu is None else mu
    c = of_key(stats, key, fold).where(F.col(key).isNotNull())
    same = Window.partitionBy(key)  # over the aggregate: as many rows a key as there are folds
    other_n = F.sum("_n").over(same) - F.col("_n")
    other_s = F.sum("_s").over(same) - F.col("_s")
    c = c.select(key, fold, other_s.alias("_os"), other_n.alias("_on"))
    te = F.when(F.col("_on") > 0, smooth_expr(F.col("_os"), F.col("_on"), smooth, mu))
    te = te.otherwise(mu) if absent == "mean" else te
    return c.select(key, fold, as_stored(te).alias(out))


def kfold_encode(train: DataFrame, key: str, y: str = "invalid_ratio", fold: str = "fold",
                 smooth: float = 30.0, out: str = "te", mu: Column | None = None,
                 fallback: Column | None = None, stats: DataFrame | None = None) -> DataFrame:
    """H2/H3/H4/H6: add the out-of-fold encoding of ``key`` to every train row. ``stats``: those of :func:`stored_stats`.

    Rows whose key is null get ``fallback`` (default ``mu``), as the
    reference fills unmapped rows with the global mean.
    """
    stats = stored_stats(train, [key], y, fold) if stats is None else stats
    mu = mean_of(stats) if mu is None else mu
    tab = kfold_table(train, key, y, fold, smooth, mu, "_zk_te", stats=stats)
    joined = train.join(tab, on=[key, fold], how="left")
    fill = mu if fallback is None else fallback
    return joined.withColumn(out, F.coalesce(F.col("_zk_te"), as_stored(fill))).drop("_zk_te")


def encode_train_test(train: DataFrame, test: DataFrame, key: str, y: str = "invalid_ratio",
                      fold: str = "fold", smooth: float = 30.0, out: str = "te",
                      unseen: str = "mean") -> tuple[DataFrame, DataFrame, DataFrame]:
    """H2 + H1 together: (train with OOF encoding, test with full encoding, map).

    ``unseen='mean'`` fills unseen test keys with ``mu``; ``'null'`` leaves them
    null for a later fallback (H3 -> D5/D6).
    """
    stats = stored_stats(train, [key], y, fold)
    mu = mean_of(stats)
    tr = kfold_encode(train, key, y, fold, smooth, out, mu, stats=stats)
    enc = full_table(stats, key, smooth, mu)
    te = apply_encoding(test, enc, key, out, fill=as_stored(mu) if unseen == "mean" else None)
    return tr, te, enc


def subset_encodings(sub: DataFrame, rows: DataFrame, chain, y: str = "invalid_ratio", mu: Column | None = None) -> DataFrame:
    """H5: ``rows`` with the full encodings of ``sub`` for each (key, smoothing, column) of ``chain``; a key that ``sub``
    lacks takes the column before it, the first one the mean of ``sub``."""
    mu = global_mean(sub, y) if mu is None else mu
    before = as_stored(mu)
    for key, smooth, out in chain:
        rows = apply_encoding(rows, fit_encoding(sub, key, y, smooth, mu), key, out, fill=before)
        before = F.col(out)
    return rows


def chained_encodings(train: DataFrame, test: DataFrame | None, chain, y: str = "invalid_ratio", fold: str = "fold") -> tuple[DataFrame, DataFrame | None]:
    """H6: (train with K-fold encodings, test with full ones) for each (key, smoothing, column) of ``chain``.

    Within each fold a key that no other fold has takes the encoding before it in the chain, the first one the mean. So a
    period cell of a single fold carries its cell's out-of-fold encoding.
    """
    stats = stored_stats(train, [key for key, _, _ in chain], y, fold)
    mu = mean_of(stats)
    before, out = as_stored(mu), train
    for key, smooth, name in chain:
        table = kfold_table(train, key, y, fold, smooth, mu, "_zk_te", absent="null", stats=stats)
        out = out.join(table, on=[key, fold], how="left").withColumn(name, F.coalesce("_zk_te", before)).drop("_zk_te")
        before = F.col(name)
    return out, None if test is None else subset_encodings(train, test, chain, y, mu)


def encoding_report(df: DataFrame, col: str, enc: DataFrame | None = None,
                    key: str | None = None) -> DataFrame:
    """H8: categories, unseen rows and %, mean, std, range of an encoded column."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.sum(F.when(F.col(col).isNull(), 1).otherwise(0)).cast("long").alias("unseen_rows"),
            F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
            F.min(col).alias("min"), F.max(col).alias("max")]
    rep = df.agg(*aggs).withColumn("unseen_pct", F.col("unseen_rows") * F.lit(100.0) / F.col("rows"))
    if enc is not None:
        rep = rep.withColumn("categories", enc.select(F.count(F.lit(1))).scalar())
    return rep
