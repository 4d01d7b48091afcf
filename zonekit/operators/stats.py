"""Rank correlation, Pearson, KS, AUC and related diagnostics.

All order statistics use :mod:`zonekit.operators.ranks` (distinct-value running
sums), so no step pulls a group's rows into one task. Correlations go through
:func:`safe_corr`: a constant column gives NULL instead of the ANSI
divide-by-zero that ``corr`` raises.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ranks import join_keys, rank_table, running_totals


def safe_corr(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def rho_from_sums(sxx, syy, sxy) -> Column:
    """Correlation from sums of centred values (NULL when a side is constant: its sum is exactly 0)."""
    return F.when((sxx > 0) & (syy > 0), sxy / (F.sqrt(sxx) * F.sqrt(syy)))


def spearman(df: DataFrame, a: str, b: str, by: Sequence[str] = (), out: str = "rho",
             with_n: bool = False, parts: int | None = None) -> DataFrame:
    """Spearman rho with average ties, per ``by`` group.

    Rows with a null in either column are dropped first (pairwise complete).
    Rows are counted per ``(group, a, b)`` before anything else, so heavy ties
    collapse in the map tasks. The centred rank of ``b`` is attached to those
    counts, the rank of ``a`` comes from the running count over its distinct
    values, and rho follows from sums of centred ranks.
    """
    by = list(by)
    d = df.select(*by, F.col(a).alias("_zk_a"), F.col(b).alias("_zk_b"))
    d = d.where(F.col("_zk_a").isNotNull() & F.col("_zk_b").isNotNull()).groupBy(*by, "_zk_a", "_zk_b").agg(F.count(F.lit(1)).alias("_zk_m"))
    d = stored(d, "pairs")  # read for the ranks and again to attach them
    rb = rank_table(d, "_zk_b", by, "_zk_rb", parts, "_zk_m", centred=True)
    rows = join_keys(d, rb, [*by, "_zk_b"], "inner")
    m, r = F.col("_zk_m"), F.col("_zk_rb")
    g = rows.groupBy(*by, "_zk_a").agg(F.sum(m).alias("_zk_n"), F.sum(m * r).alias("_zk_sy"), F.sum(m * r * r).alias("_zk_syy"))
    cum = running_totals(g, ["_zk_a"], ["_zk_n"], by, parts)
    ra = F.col("_zk_n_cum") - F.col("_zk_n") / F.lit(2.0) - F.col("_zk_n_all") / F.lit(2.0)
    c = cum.withColumn("_zk_ra", ra)
    aggs = [F.sum("_zk_n").alias("n"), F.sum(F.col("_zk_n") * F.col("_zk_ra") * F.col("_zk_ra")).alias("_Sxx"),
            F.sum("_zk_syy").alias("_Syy"), F.sum(F.col("_zk_ra") * F.col("_zk_sy")).alias("_Sxy")]
    s = c.groupBy(*by).agg(*aggs) if by else c.agg(*aggs)
    cols = [*by, rho_from_sums(F.col("_Sxx"), F.col("_Syy"), F.col("_Sxy")).alias(out)]
    if with_n:
        cols.append(F.col("n").cast("long").alias("n"))
    return s.select(*cols)


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = (),
                   parts: int | None = None) -> DataFrame:
    """Rho for many column pairs, pairwise-complete, in one pass.

    The values (as DOUBLE) of each column are counted once, and for every column with nulls once more where that one is
    present, so one running count gives a column's centred ranks within each of its pairs. They are attached
    to the rows, and one aggregate adds up the products of all pairs; the sums of squares come from the rank table.
    A row is so held once, not once a pair. Returns ``by..., a, b, rho`` (long form).
    """
    by, pairs = list(by), list(pairs)
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(cols)}
    d = df.select(*by, *[F.col(c).cast("double").alias(f"_zk_{i}") for i, c in enumerate(cols)])
    empty = d.agg(*[F.count_if(F.col(f"_zk_{i}").isNull()).alias(f"_zk_{i}") for i in range(len(cols))]).first()
    holes = [i for i in range(len(cols)) if empty[i]]
    side = lambda other: str(at[other]) if at[other] in holes else "all"

    # counts a value: of all rows, and of those where a column with holes has a value
    items = F.array(*[F.struct(F.lit(i).alias("_zk_col"), F.col(f"_zk_{i}").alias("_zk_val")) for i in range(len(cols))])
    long = d.select(*by, *[F.col(f"_zk_{j}").isNotNull().alias(f"_zk_has_{j}") for j in holes], F.explode(items).alias("_zk_s")) \
        .select(*by, *[f"_zk_has_{j}" for j in holes], "_zk_s.*").where(F.col("_zk_val").isNotNull())
    counts = long.groupBy(*by, "_zk_col", "_zk_val").agg(F.count(F.lit(1)).alias("_zk_n_all"), *[F.count_if(F.col(f"_zk_has_{j}")).alias(f"_zk_n_{j}") for j in holes])
    kinds = ["all", *map(str, holes)]
    cum = running_totals(counts, ["_zk_val"], [f"_zk_n_{k}" for k in kinds], [*by, "_zk_col"], parts)
    rank = lambda k: F.col(f"_zk_n_{k}_cum") - F.col(f"_zk_n_{k}") / F.lit(2.0) - F.col(f"_zk_n_{k}_all") / F.lit(2.0)
    ranks = stored(cum.select(*by, "_zk_col", "_zk_val", *[f"_zk_n_{k}" for k in kinds], *[rank(k).alias(f"_zk_r_{k}") for k in kinds]), "ranks")

    out = d
    for i in range(len(cols)):
        own = ranks.where(F.col("_zk_col") == i).select(*by, F.col("_zk_val").alias("_zk_v"), *[F.col(f"_zk_r_{k}").alias(f"_zk_r_{i}_{k}") for k in kinds])
        out = join_keys(out.withColumnRenamed(f"_zk_{i}", "_zk_v"), own, [*by, "_zk_v"], "left").drop("_zk_v")
    products = [F.sum(F.col(f"_zk_r_{at[x]}_{side(y)}") * F.col(f"_zk_r_{at[y]}_{side(x)}")).alias(f"_zk_xy_{p}") for p, (x, y) in enumerate(pairs)]
    squares = [F.sum(F.col(f"_zk_n_{k}") * F.col(f"_zk_r_{k}") * F.col(f"_zk_r_{k}")).alias(f"_zk_sq_{k}") for k in kinds]
    xy = (out.groupBy(*by).agg(*products) if by else out.agg(*products)) \
        .select(*by, F.posexplode(F.array(*[f"_zk_xy_{p}" for p in range(len(pairs))])).alias("_zk_p", "_Sxy"))
    sq = ranks.groupBy(*by, "_zk_col").agg(*squares)
    sq = sq.select(*by, F.col("_zk_col").alias("_zk_of"), F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in kinds]), F.array(*[f"_zk_sq_{k}" for k in kinds]))).alias("_zk_in", "_zk_sq"))
    names = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.lit(at[x]).alias("i"), F.lit(at[y]).alias("j"),
                               F.lit(side(y)).alias("x_in"), F.lit(side(x)).alias("y_in")) for x, y in pairs])
    rho = xy.where(F.col("_Sxy").isNotNull()).withColumn("_zk_of_pair", names[F.col("_zk_p")]).select(*by, "_Sxy", "_zk_of_pair.*")
    for of, kind, name in (("i", "x_in", "_Sxx"), ("j", "y_in", "_Syy")):
        rho = join_keys(rho, sq.select(*by, F.col("_zk_of").alias(of), F.col("_zk_in").alias(kind), F.col("_zk_sq").alias(name)), [*by, of, kind], "left")
    return rho.select(*by, "a", "b", rho_from_sums(F.col("_Sxx"), F.col("_Syy"), F.col("_Sxy")).alias("rho"))


def pearson(df: DataFrame, a: str, b: str, by: Sequence[str] = (), out: str = "r") -> DataFrame:
    """Pearson correlation (guarded)."""
    by = list(by)
    agg = safe_corr(a, b).alias(out)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def ks_two_sample(df: DataFrame, value: str, sample: str, first="train", second="test",
                  by: Sequence[str] = (), out: str = "ks", parts: int | None = None) -> DataFrame:
    """Two-sample KS statistic ``max |F1(x) - F2(x)|`` per ``by`` group.

    Counts per distinct value for both samples, running sums on the distinct
    values (range-partitioned), then the maximum gap.
    """
    by = list(by)
    d = df.where(F.col(value).isNotNull())
    counts = d.groupBy(*by, value).agg(
        F.sum(F.when(F.col(sample) == F.lit(first), 1).otherwise(0)).cast("long").alias("_a"),
        F.sum(F.when(F.col(sample) == F.lit(second), 1).otherwise(0)).cast("long").alias("_b"))
    j = running_totals(counts, [value], ["_a", "_b"], by, parts)
    gap = F.abs(F.try_divide("_a_cum", "_a_all") - F.try_divide("_b_cum", "_b_all"))
    return j.groupBy(*by).agg(F.max(gap).alias(out)) if by else j.agg(F.max(gap).alias(out))


def ks_pvalue_expr(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value ``Q(lambda)``, ``lambda = d*sqrt(nm/(n+m))``.

    From lambda 1 on the Kolmogorov series ``2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)``,
    below it the theta series ``1 - sqrt(2 pi)/lambda * sum exp(-(2k-1)^2 pi^2/(8 lambda^2))``;
    on its side of 1 each reaches double precision within the terms taken. Q(0) is 1. This is the
    large-sample limit; :func:`ks_test` takes the exact distribution for small samples.
    """
    lam = d * F.sqrt(n * m / (n + m))
    tail = theta = None
    for k in range(1, 6):
        term = F.exp(F.lit(-2.0 * k * k) * lam * lam) * F.lit(2.0 if k % 2 else -2.0)
        tail = term if tail is None else tail + term
        term = F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
        theta = term if theta is None else theta + term
    low = F.lit(1.0) - F.lit(math.sqrt(2.0 * math.pi)) / lam * theta
    return F.when(lam <= 0, F.lit(1.0)).when(lam < 1, F.least(low, F.lit(1.0))).otherwise(F.greatest(tail, F.lit(0.0)))


#: Values of both samples together up to which the p-value is exact.
EXACT_VALUES = 200


def ks_exact(h: int, n: int, m: int) -> float:
    """P(D >= h / (n m)) for two samples of n and m distinct values in random order.

    An order of both samples is a lattice path from (0, 0) to (n, m), all equally likely; D stays below h / (n m) on those
    that keep |i m - j n| < h. They are counted row by row, in whole numbers.
    """
    if h <= 0:
        return 1.0
    row = [1 if j * n < h else 0 for j in range(m + 1)]
    for j in range(1, m + 1):
        row[j] = row[j] and row[j - 1]
    for i in range(1, n + 1):
        row[0] = row[0] if i * m < h else 0
        for j in range(1, m + 1):
            row[j] = row[j] + row[j - 1] if abs(i * m - j * n) < h else 0
    paths = math.comb(n + m, n)
    return (paths - row[m]) / paths


def ks_test(df: DataFrame, value: str, sample: str, first="train", second="test", by: Sequence[str] = (),
            exact_values: int = EXACT_VALUES, parts: int | None = None) -> DataFrame:
    """G8 + G9: ``by..., ks, n_first, n_second, p_value, exact`` per group that has both samples.

    The p-value is exact (:func:`ks_exact`) up to ``exact_values`` values of both, asymptotic beyond. As usual the distribution is that of
    distinct values; ties make the exact one conservative. The largest gap is kept as a whole number of 1 / (n m).
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.count_if(F.col(sample) == F.lit(first)).alias("_a"), F.count_if(F.col(sample) == F.lit(second)).alias("_b"))
    j = running_totals(counts, [value], ["_a", "_b"], by, parts)
    small = F.col("_a_all") + F.col("_b_all") <= exact_values
    whole = F.abs(F.col("_a_cum") * F.col("_b_all") - F.col("_b_cum") * F.col("_a_all"))
    gap = F.abs(F.try_divide("_a_cum", "_a_all") - F.try_divide("_b_cum", "_b_all"))
    aggs = [F.max(gap).alias("ks"), F.max("_a_all").alias("n_first"), F.max("_b_all").alias("n_second"), F.max(F.when(small, whole)).alias("_h")]
    g = (j.groupBy(*by).agg(*aggs) if by else j.agg(*aggs)).where("n_first > 0 and n_second > 0")

    @F.arrow_udf("double")
    def exact(h: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        known: dict = {}
        out = []
        for key in zip(h.to_pylist(), n.to_pylist(), m.to_pylist()):
            if key not in known:
                known[key] = None if key[0] is None else ks_exact(*key)
            out.append(known[key])
        return pa.array(out, pa.float64())

    large = ks_pvalue_expr(F.col("ks"), F.col("n_first").cast("double"), F.col("n_second").cast("double"))
    p = F.coalesce(exact("_h", "n_first", "n_second"), large)
    return g.select(*by, "ks", "n_first", "n_second", p.alias("p_value"), F.col("_h").isNotNull().alias("exact"))


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (), out: str = "auc",
        parts: int | None = None) -> DataFrame:
    """ROC AUC by Mann-Whitney: ``(sum rank_pos - n1(n1+1)/2) / (n0 n1)``."""
    by = list(by)
    pos = F.col(label) == F.lit(1)
    # both classes are counted per distinct score; the rank of a score follows from the running count
    g = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(
        F.count(F.lit(1)).alias("_zk_n"), F.count_if(pos).alias("_zk_pos"))
    c = running_totals(g, [score], ["_zk_n"], by, parts)
    rank = F.col("_zk_n_cum") - F.col("_zk_n") + (F.col("_zk_n") + F.lit(1)) / F.lit(2.0)
    n1 = F.sum("_zk_pos").cast("double")
    n0 = F.sum(F.col("_zk_n") - F.col("_zk_pos")).cast("double")
    s1 = F.sum(rank * F.col("_zk_pos"))
    val = F.try_divide(s1 - n1 * (n1 + F.lit(1.0)) / F.lit(2.0), n0 * n1).alias(out)
    return c.groupBy(*by).agg(val) if by else c.agg(val)


def leakage_gate(rho: Column, lo: float = 0.1, hi: float = 0.7) -> Column:
    """PASS inside (lo, hi), LEAK above, WEAK below."""
    return (F.when(rho > F.lit(hi), F.lit("LEAK"))
            .when(rho < F.lit(lo), F.lit("WEAK"))
            .otherwise(F.lit("PASS")))
