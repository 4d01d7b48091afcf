"""Projections, fills, filters and predicates (B1-B14) plus cell statistics.

Fitted constants (medians, global statistics) are scalar subqueries: Spark runs
them once as a small job and inlines the value, so nothing row-level passes
through the driver and no cross join is needed to attach a scalar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .ranks import exact_quantiles


def cast_schema(df: DataFrame, schema: StructType | Mapping[str, str]) -> DataFrame:
    """B1: cast columns to declared types (others untouched)."""
    types = ({f.name: f.dataType for f in schema.fields} if isinstance(schema, StructType)
             else dict(schema))
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def trim_outliers(df: DataFrame, cols: Sequence[str], q: float = 0.001) -> DataFrame:
    """Keep rows whose every column is above its exact ``q`` quantile."""
    cond = None
    for c in cols:
        lim = exact_quantiles(df, c, [q]).select("value").scalar()
        part = F.col(c) > lim
        cond = part if cond is None else cond & part
    return df.where(cond)


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant fill of nulls."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


class MedianFill:
    """Median fitted on one frame (train), applied to any frame."""

    def __init__(self, col: str):
        self.col = col
        self.median: Column | None = None

    def fit(self, df: DataFrame) -> "MedianFill":
        self.median = exact_quantiles(df, self.col, [0.5]).select("value").scalar()
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.col, F.coalesce(F.col(self.col), self.median))


def cell_stats(train: DataFrame, key: str = "grid_id", y: str = "invalid_ratio",
               count_col: str = "total_count") -> DataFrame:
    """Per-cell mean count, target std (one row -> 0), row count."""
    return train.groupBy(key).agg(
        F.avg(count_col).alias("grid_avg_count"),
        F.coalesce(F.stddev_samp(y), F.lit(0.0)).alias("grid_violation_std"),
        F.count(y).cast("double").alias("grid_sample_count"))


def global_stats(train: DataFrame, key: str = "grid_id", y: str = "invalid_ratio",
                 count_col: str = "total_count", sizes: DataFrame | None = None) -> dict[str, Column]:
    """Global mean count, target std and the median cell size (scalars). ``sizes``: rows of each cell as ``_zk_sz``, if at hand."""
    sizes = train.groupBy(key).agg(F.count(y).alias("_zk_sz")) if sizes is None else sizes
    return {
        "grid_avg_count": train.select(F.avg(count_col)).scalar(),
        "grid_violation_std": train.select(F.stddev_samp(y)).scalar(),
        "grid_sample_count": exact_quantiles(sizes, "_zk_sz", [0.5]).select("value").scalar(),
    }


def fill_unseen(df: DataFrame, stats: Mapping[str, Column]) -> DataFrame:
    """Fill unmatched group statistics with the global ones."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in stats.items()})


def overwrite_when(c: str, cond: Column, value) -> Column:
    """Conditional overwrite of a label or weight."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(cond, v).otherwise(F.col(c))


def swap_columns(df: DataFrame, repl: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Replace ``cols`` of ``df`` with those of ``repl`` matched on ``key``."""
    return df.drop(*cols).join(repl.select(key, *cols), on=key, how="left")


def noise_candidates(p: str = "oof", y: str = "invalid_ratio", tc: str = "total_count",
                     lo: float = 0.15, hi: float = 0.85) -> Column:
    """``tc=1 AND ((p<lo AND y=1) OR (p>hi AND y=0))``."""
    return (F.col(tc) == 1) & (((F.col(p) < lo) & (F.col(y) == 1.0)) |
                               ((F.col(p) > hi) & (F.col(y) == 0.0)))


def confidence_layer(p: str = "pred", l1: float = 0.02, l2: float = 0.10) -> Column:
    """1 if ``p<l1 OR p>1-l1``; 2 if ``p<l2 OR p>1-l2`` (and not 1); else null."""
    x = F.col(p)
    return (F.when((x < l1) | (x > 1 - l1), F.lit(1))
            .when((x < l2) | (x > 1 - l2), F.lit(2)))
