"""Bound view ``zone_obs``: the observation schema laid over the driver tables.

The driver tables carry no zones or ratios, so ``lineitem`` is mapped onto the
observation schema (row id, count, coordinates, weather, time fields, target
ratio, two stand-in model predictions, train/test split). The same expression
text is used for the Spark DataFrame and for the DuckDB oracle CTE, so both
engines see identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The bound-view expressions (inner projection over lineitem).
INNER_EXPRS = [
    # order and line in the upper 33 bits, a hash of the other keys and the price in the lower 30: no product leaves
    # 63 bits, whatever the keys (orders repeat beyond 1e9, where the hash still tells their lines apart)
    ("((l_orderkey * 8 + l_linenumber) % 8589934592) * 1073741824 + ((l_partkey % 1073741824) * 1000003 + "
     "(l_suppkey % 1073741824) * 10007 + CAST(round(l_extendedprice * 1e2) AS BIGINT) % 1073741824) % 1073741789", "row_id"),
    ("l_suppkey", "l_suppkey"),
    ("CAST(l_quantity AS INT)", "total_count"),
    ("9.95e-1 + 6e-5 * CAST(l_suppkey % 40 AS DOUBLE)", "lon"),
    ("9.96e-1 + 7e-5 * CAST(l_suppkey % 25 AS DOUBLE)", "lat"),
    ("CASE WHEN l_tax >= 5e-2 THEN l_tax * 1e2 ELSE 0e0 END", "precip"),
    ("CASE WHEN l_linenumber = 7 THEN NULL WHEN month(l_shipdate) IN (12,1,2) THEN l_tax ELSE 0e0 END", "snow"),
    ("l_extendedprice / 3e3 - 5e0", "temp"),
    ("CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_tax * 1e2 END", "wind"),
    ("CAST(l_partkey % 14 + 6 AS INT)", "hour"),
    ("CAST(l_orderkey % 6 + 1 AS INT)", "dow"),
    ("CAST(month(l_shipdate) AS INT)", "month"),
    ("CAST(year(l_shipdate) AS INT)", "yr"),
    ("CASE WHEN l_quantity = 1e0 THEN (CASE WHEN l_discount > 5e-2 THEN 1e0 ELSE 0e0 END) "
     "ELSE round(l_discount * 1e1, 1) END", "invalid_ratio"),
    ("l_extendedprice / 1.05e5", "pred_a"),
    ("6e-1 * l_discount * 1e1 + 4e-1 * l_quantity / 5e1", "pred_b"),
]
SPLIT_EXPR = ("CASE WHEN yr = 2001 AND month <= 5 THEN 'test' "
              "WHEN l_suppkey % 50 = 7 THEN 'test' ELSE 'train' END")
OUTER_COLS = ["row_id", "total_count", "lon", "lat", "precip", "snow", "temp", "wind",
              "hour", "dow", "month", "invalid_ratio", "pred_a", "pred_b"]

# Raw observation feature columns (the reference's ten inputs, renamed).
RAW_FEATURES = ["total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month"]
TARGET = "invalid_ratio"


def zone_obs_sql(source: str = "lineitem") -> str:
    inner = ", ".join(f"{e} AS {a}" for e, a in INNER_EXPRS)
    return (f"SELECT {', '.join(OUTER_COLS)}, {SPLIT_EXPR} AS split "
            f"FROM (SELECT {inner} FROM {source}) t")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zone_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All observations (train and test) with a ``split`` column."""
    li = table(spark, sf_dir, "lineitem")
    inner = li.selectExpr(*[f"{e} AS {a}" for e, a in INNER_EXPRS])
    return inner.selectExpr(*OUTER_COLS, f"{SPLIT_EXPR} AS split")


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    z = zone_obs(spark, sf_dir)
    return z.where("split = 'train'"), z.where("split = 'test'")
