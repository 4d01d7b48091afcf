"""Validation gates and result tables (M1-M8).

Each check is one aggregate turned into rows ``(check, value, status)``; the
driver only ever sees these small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .profile import null_profile


def assert_no_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M1: null count per column with PASS/FAIL."""
    n = null_profile(df, cols, keep_positive=False)
    return n.withColumn("status", F.when(F.col("nulls") == 0, "PASS").otherwise("FAIL"))


def check_predictions(pred: DataFrame, col: str, expected_rows: Column | int, train_mean: Column,
                      gap_limit: float = 0.05) -> DataFrame:
    """M2: null count, row count, range and mean gap to the train mean, one aggregate."""
    exp = expected_rows if isinstance(expected_rows, Column) else F.lit(int(expected_rows))
    a = pred.agg(F.sum(F.when(F.col(col).isNull() | F.isnan(col), 1).otherwise(0)).cast("double").alias("nulls"),
                 F.count(F.lit(1)).cast("double").alias("rows"), F.min(col).alias("min"), F.max(col).alias("max"),
                 F.avg(col).alias("mean"))
    a = a.withColumn("gap", F.abs(F.col("mean") - train_mean)).withColumn("expected", exp.cast("double"))
    checks = F.array(
        F.struct(F.lit("nulls").alias("check"), F.col("nulls").alias("value"), (F.col("nulls") == 0).alias("ok")),
        F.struct(F.lit("rows").alias("check"), F.col("rows").alias("value"), (F.col("rows") == F.col("expected")).alias("ok")),
        F.struct(F.lit("min").alias("check"), F.col("min").alias("value"), (F.col("min") >= 0).alias("ok")),
        F.struct(F.lit("max").alias("check"), F.col("max").alias("value"), (F.col("max") <= 1).alias("ok")),
        F.struct(F.lit("mean_gap").alias("check"), F.col("gap").alias("value"), (F.col("gap") < gap_limit).alias("ok")))
    return a.select(F.explode(checks).alias("c")).select(
        "c.check", "c.value", F.when(F.col("c.ok"), "PASS").otherwise("FAIL").alias("status"))


def check_columns(train: DataFrame, test: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """M3: every column of either side: its non-null values on both (null: no such column) and a status.

    PASS: on both sides, with values on both; EMPTY: on both, but without a value on one; TRAIN_ONLY, TEST_ONLY.
    """
    def values(df: DataFrame, side: str) -> DataFrame:
        cols = [c for c in df.columns if c not in exclude]
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
        items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(side)) for c in cols])
        return counts.select(F.explode(items).alias("x")).select("x.*")

    both = values(train, "train_values").join(values(test, "test_values"), on="column", how="full")
    a, b = F.col("train_values"), F.col("test_values")
    return both.withColumn("status", F.when(b.isNull(), "TRAIN_ONLY").when(a.isNull(), "TEST_ONLY").when((a == 0) | (b == 0), "EMPTY").otherwise("PASS"))


def check_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """M4: row count unchanged by a pipeline (catches duplicate keys in lookups)."""
    nb = before.select(F.count(F.lit(1))).scalar()
    na = after.select(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(nb.alias("rows_before"), na.alias("rows_after"),
                                               F.when(nb == na, "PASS").otherwise("FAIL").alias("status"))


def history(scores: DataFrame, order: str = "version", value: str = "score") -> DataFrame:
    """M5: version table with deltas to the previous version (a handful of rows)."""
    w = Window.orderBy(order)
    return scores.withColumn("delta", F.col(value) - F.lag(value).over(w))


def gate(score: float, limit: float) -> bool:
    """M6: driver-side decision on a one-row result: run the next step or not."""
    return score is not None and score >= limit
