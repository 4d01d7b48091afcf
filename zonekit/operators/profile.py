"""Table profiles, group statistics, histograms and calibration.

Every profile is one grouped aggregate (partial aggregation on the map side)
or an unpivot followed by one. Quantiles are exact and come from
:func:`zonekit.operators.ranks.exact_quantiles` (distinct-value intervals),
never from gathering a group's values in one task. Histogram edges are scalar
subqueries (min/max), so binning is a projection plus a grouped count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, ByteType)

from ..session import stored
from .ranks import exact_quantiles, value_intervals


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), name: str = "feature",
         value: str = "value") -> DataFrame:
    """Unpivot ``cols`` (as DOUBLE) into ``by..., name, value`` rows."""
    by = list(by)
    items = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*by, F.explode(items).alias("_zk_m")).select(*by, f"_zk_m.{name}", f"_zk_m.{value}")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75%, max per column (long form)."""
    # rows are unpivoted once; moments and quantiles come from the distinct values and their counts
    iv = stored(value_intervals(melt(df, cols), "value", by=["feature"]), "values")
    n, v = F.col("n"), F.col("value")
    base = iv.groupBy("feature").agg(F.sum("n").alias("count"), (F.sum(n * v) / F.sum("n")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    spread = iv.join(base.select("feature", F.col("mean").alias("_zk_m")), on="feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(n * (v - F.col("_zk_m")) ** 2), F.sum("n") - 1)).alias("std"))
    q = exact_quantiles(iv, "value", [0.25, 0.5, 0.75], by=["feature"], intervals=iv)
    qw = q.groupBy("feature").agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                                   for v, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    return base.join(spread, on="feature").join(qw, on="feature", how="left").select("feature", "count", "mean", "std", "min", "max", "p25", "p50", "p75")


_SQL_TYPE = {IntegerType: "INTEGER", LongType: "BIGINT", DoubleType: "DOUBLE", FloatType: "FLOAT",
             StringType: "VARCHAR", BooleanType: "BOOLEAN", ShortType: "SMALLINT", ByteType: "TINYINT"}


def info(df: DataFrame) -> DataFrame:
    """Column, SQL type name and non-null count, from one aggregate."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = {f.name: _SQL_TYPE.get(type(f.dataType), f.dataType.simpleString().upper()) for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{types[c]}', `{c}`" for c in df.columns)
    return counts.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column, dtype, non_null)")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, keep_positive: bool = True) -> DataFrame:
    """Null count and rate per column; only columns with nulls by default."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_zk_n"),
                 *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    out = agg.selectExpr("_zk_n", f"stack({len(cols)}, {stack}) AS (column, nulls)") \
        .withColumn("null_pct", F.col("nulls") * F.lit(100.0) / F.col("_zk_n")).drop("_zk_n")
    return out.where(F.col("nulls") > 0) if keep_positive else out


def group_stats(df: DataFrame, by: Sequence[str], y: str) -> DataFrame:
    """Count, mean, std and exact median of ``y`` per group."""
    by = list(by)
    base = df.groupBy(*by).agg(F.count(y).alias("count"), F.avg(y).alias("mean"),
                               F.stddev_samp(y).alias("std"))
    med = exact_quantiles(df, y, [0.5], by).select(*by, F.col("value").alias("median"))
    return base.join(med, on=by, how="left")


def temporal_profile(df: DataFrame, dims: Sequence[str], y: str) -> DataFrame:
    """E5: mean, standard error and a +-2 sem band of ``y`` per value of each dim."""
    m = df.select(F.col(y), F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("long").alias("key"))
                                                for d in dims])).alias("_zk_d")).select("_zk_d.dim", "_zk_d.key", y)
    g = m.groupBy("dim", "key").agg(F.count(y).alias("n"), F.avg(y).alias("mean"),
                                    (F.stddev_samp(y) / F.sqrt(F.count(y))).alias("sem"))
    return g.withColumns({"lo": F.col("mean") - F.lit(2.0) * F.col("sem"),
                          "hi": F.col("mean") + F.lit(2.0) * F.col("sem")})


def extreme_groups(profile: DataFrame, by: Sequence[str] = ("dim",), key: str = "key",
                   value: str = "mean") -> DataFrame:
    """Key with the largest and the smallest value; ties go to the first (smallest) key."""
    by = list(by)
    hi = F.max_by(F.col(key), F.struct(F.col(value), -F.col(key))).alias("max_key")
    lo = F.min_by(F.col(key), F.struct(F.col(value), F.col(key))).alias("min_key")
    return profile.groupBy(*by).agg(hi, F.max(value).alias("max_value"), lo, F.min(value).alias("min_value"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value (sort by key when presenting)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def n_unique(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys and mean rows per key (exact two-phase distinct)."""
    return df.agg(F.countDistinct(key).alias("n_unique"),
                  (F.count(F.lit(1)) / F.countDistinct(key)).alias("rows_per_key"))


def share(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Share of rows satisfying each predicate (one aggregate)."""
    return df.agg(*[F.avg(c.cast("double")).alias(n) for n, c in conds.items()])


def _bounds(df: DataFrame, col: str) -> tuple[Column, Column]:
    lo, hi = F.min(col), F.max(col)
    half = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))
    b = df.select(F.struct((lo - half).alias("lo"), (hi + half).alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


def with_bins(df: DataFrame, col: str, lo: Column, hi: Column, bins: int, out: str = "bin") -> DataFrame:
    """Equal-width bin of ``col`` in ``[lo, hi]`` with edge corrections (last bin closed).

    ``f = (x - lo) / (hi - lo) * bins`` truncated, then corrected against the
    edges ``k * step + lo`` (last edge exactly ``hi``), so values within an ulp
    of an edge land where an edge comparison puts them.
    """
    step = (F.col("_zk_hi") - F.col("_zk_lo")) / F.lit(float(bins))

    def edge(k: Column) -> Column:
        return F.when(k == F.lit(bins), F.col("_zk_hi")).otherwise(k.cast("double") * step + F.col("_zk_lo"))

    x = F.col(col)
    d = df.withColumns({"_zk_lo": lo, "_zk_hi": hi})
    d = d.withColumn("_zk_i", (((x - F.col("_zk_lo")) / (F.col("_zk_hi") - F.col("_zk_lo"))) * F.lit(float(bins))).cast("long"))
    d = d.withColumn("_zk_i", F.when(F.col("_zk_i") == F.lit(bins), F.lit(bins - 1)).otherwise(F.col("_zk_i")))
    d = d.withColumn("_zk_i", F.when(x < edge(F.col("_zk_i")), F.col("_zk_i") - 1).otherwise(F.col("_zk_i")))
    d = d.withColumn(out, F.when((x >= edge(F.col("_zk_i") + 1)) & (F.col("_zk_i") != F.lit(bins - 1)),
                                 F.col("_zk_i") + 1).otherwise(F.col("_zk_i")))
    return d.drop("_zk_i")


def histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = (),
              lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """Equal-width counts; ``by`` splits with shared edges.

    Returns ``by..., bin, left, right, count``; empty bins are omitted.
    """
    by = list(by)
    d = df.where(F.col(col).isNotNull())
    if lo is None or hi is None:
        lo, hi = _bounds(d, col)
    b = with_bins(d.select(*by, col), col, lo, hi, bins)
    g = b.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"), F.min("_zk_lo").alias("_zk_lo"),
                                  F.min("_zk_hi").alias("_zk_hi"))
    step = (F.col("_zk_hi") - F.col("_zk_lo")) / F.lit(float(bins))
    right = F.when(F.col("bin") + 1 == F.lit(bins), F.col("_zk_hi")).otherwise(
        (F.col("bin") + 1).cast("double") * step + F.col("_zk_lo"))
    return g.withColumns({"left": F.col("bin").cast("double") * step + F.col("_zk_lo"), "right": right}) \
        .drop("_zk_lo", "_zk_hi")


def density_histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Per-source density histograms, ``count / (n * width)``, each with its own edges."""
    out = None
    for c in cols:
        h = histogram(df, c, bins)
        n = df.select(F.count(c)).scalar()
        h = h.select(F.lit(c).alias("source"), "bin", "left", "right", "count",
                     (F.col("count") / (n * (F.col("right") - F.col("left")))).alias("density"))
        out = h if out is None else out.unionByName(h)
    return out


def box_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5*IQR whisker ends (most extreme data inside) and outlier count."""
    by = list(by)
    d = df.where(F.col(col).isNotNull())
    q = exact_quantiles(d, col, [0.25, 0.5, 0.75], by)
    qw = q.groupBy(*by).agg(*[F.max(F.when(F.col("q") == v, F.col("value"))).alias(n)
                              for v, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    iqr = F.col("q3") - F.col("q1")
    qw = qw.withColumns({"_zk_lo": F.col("q1") - F.lit(1.5) * iqr, "_zk_hi": F.col("q3") + F.lit(1.5) * iqr})
    j = d.join(qw, on=by, how="inner")
    x = F.col(col)
    g = j.groupBy(*by, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(x >= F.col("_zk_lo"), x)).alias("_wl"),
        F.max(F.when(x <= F.col("_zk_hi"), x)).alias("_wh"))
    g = g.withColumns({"whislo": F.coalesce("_wl", "q1"), "whishi": F.coalesce("_wh", "q3")}).drop("_wl", "_wh")
    fl = j.join(g.select(*by, "whislo", "whishi"), on=by, how="inner").groupBy(*by).agg(
        F.sum(F.when((x < F.col("whislo")) | (x > F.col("whishi")), 1).otherwise(0)).cast("long").alias("n_fliers"))
    return g.join(fl, on=by, how="inner")


def rate_by(df: DataFrame, by: Sequence[str], num: Column, den: Column, out: str = "rate") -> DataFrame:
    """``sum(num) / greatest(sum(den), 1)`` per group, with both sums."""
    by = list(by)
    return df.groupBy(*by).agg(F.sum(num.cast("long")).alias("num"), F.sum(den.cast("long")).alias("den")) \
        .withColumn(out, F.col("num") / F.greatest(F.col("den"), F.lit(1)))


def tail_yield(df: DataFrame, p: str, ts: Sequence[float]) -> DataFrame:
    """Rows with ``p < t OR p > 1 - t`` for each threshold (one aggregate)."""
    x = F.col(p)
    aggs = [F.sum(F.when((x < F.lit(t)) | (x > F.lit(1.0 - t)), 1).otherwise(0)).cast("long").alias(f"t{i}")
            for i, t in enumerate(ts)]
    wide = df.agg(F.count(F.lit(1)).alias("_zk_n"), *aggs)
    stack = ", ".join(f"CAST({t!r} AS DOUBLE), t{i}" for i, t in enumerate(ts))
    return wide.selectExpr("_zk_n", f"stack({len(ts)}, {stack}) AS (threshold, n_rows)") \
        .withColumn("pct", F.col("n_rows") * F.lit(100.0) / F.col("_zk_n")).drop("_zk_n")


def calibration(df: DataFrame, p: str, y: str, q: int = 10) -> DataFrame:
    """Quantile bins of ``p`` (duplicate edges dropped, right-closed, lowest included),
    mean prediction and mean actual per bin.

    The bin table has at most ``q`` rows by construction, so it is broadcast
    (a proven size bound) and rows meet it in a range join.
    """
    d = df.where(F.col(p).isNotNull())
    edges = exact_quantiles(d, p, [i / q for i in range(q + 1)]).select(F.col("value").alias("lo")).distinct()
    w = Window.orderBy("lo")  # at most q + 1 rows
    bins = (edges.withColumn("bin", (F.row_number().over(w) - 1).cast("int"))
            .withColumn("hi", F.lead("lo").over(w)).where(F.col("hi").isNotNull()))
    x = F.col(p)
    b = F.broadcast(bins)
    cond = ((x > b["lo"]) & (x <= b["hi"])) | ((b["bin"] == 0) & (x == b["lo"]))
    binned = d.join(b, cond, "inner")
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("pred_mean"),
                                     F.avg(y).alias("actual_mean"))


def summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, std, min, max and exact median of one column."""
    base = df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).alias("min"), F.max(col).alias("max"))
    med = exact_quantiles(df, col, [0.5]).select("value").scalar()
    return base.withColumn("median", med)


def indicator_effect(df: DataFrame, ind: str, y: str) -> DataFrame:
    """Mean target with and without the indicator, and the difference."""
    on = F.col(ind) == 1
    return df.agg(F.avg(F.when(on, F.col(y))).alias("mean_on"), F.avg(F.when(~on, F.col(y))).alias("mean_off")) \
        .withColumn("diff", F.col("mean_on") - F.col("mean_off"))
