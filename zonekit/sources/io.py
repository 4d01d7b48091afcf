"""Sources and sinks (A1-A10): typed CSV scan, parquet tiers, encoder tables,
submission files and per-fold prediction checkpoints.

All paths are expected under the shared folder (``spark.checkpoint.dir`` or a
cluster filesystem); nothing is written to a machine-local folder. Writes are
whole-partition overwrites, so a retried task or job leaves no partial state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.features import clip01

# Observation schema (declared, never inferred). int8 time fields widen to INT,
# float32 measures to DOUBLE; the row id is an explicit LONG key.
OBS_SCHEMA = StructType([
    StructField("total_count", IntegerType()),
    StructField("lon", DoubleType()),
    StructField("lat", DoubleType()),
    StructField("precip", DoubleType()),
    StructField("snow", DoubleType()),
    StructField("temp", DoubleType()),
    StructField("wind", DoubleType()),
    StructField("hour", IntegerType()),
    StructField("dow", IntegerType()),
    StructField("month", IntegerType()),
])
CSV_SCHEMA = StructType([StructField("row_id", LongType()), *OBS_SCHEMA.fields])
TARGET_SCHEMA = StructType([StructField("row_id", LongType()), StructField("invalid_ratio", DoubleType())])


def read_observations(spark: SparkSession, path: str, schema: StructType = CSV_SCHEMA) -> DataFrame:
    """A1: typed CSV scan; the first column is the row id. NaN text becomes NULL."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
          .option("nanValue", "NaN").csv(path))
    dbl = [f.name for f in schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in dbl})


def attach_target(x: DataFrame, y: DataFrame, key: str = "row_id") -> DataFrame:
    """A2: 1:1 join of features and target on the row id (inner)."""
    return x.join(y, on=key, how="inner")


def save_tier(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """A3: write a parquet tier and return the re-read frame (cuts lineage)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_columns(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """A4: column-pruned parquet scan (only ``cols`` are read)."""
    return spark.read.parquet(path).select(*cols)


def save_encoder(tables: dict[str, DataFrame], constants: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """A5: encoder maps as one parquet ``(encoder, key, te, n)`` plus a one-row constants table."""
    parts = [t.select(F.lit(name).alias("encoder"), F.col(t.columns[0]).cast("long").alias("key"),
                      F.col("te").cast("double").alias("te"), F.col("n").cast("long").alias("n"))
             for name, t in tables.items()]
    allmaps = parts[0]
    for p in parts[1:]:
        allmaps = allmaps.unionByName(p)
    allmaps.write.mode("overwrite").partitionBy("encoder").parquet(f"{path}/maps")
    constants.write.mode("overwrite").parquet(f"{path}/constants")
    spark = allmaps.sparkSession
    return spark.read.parquet(f"{path}/maps"), spark.read.parquet(f"{path}/constants")


def _absent(error: AnalysisException) -> bool:
    """Whether the path isn't there or holds no table (anything else is an error to raise)."""
    return (error.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_submission(pred: DataFrame, path: str, col: str = "pred", key: str = "row_id",
                     out: str = "invalid_ratio") -> DataFrame:
    """A6 + B9: row id and clipped prediction as CSV with a header.

    Written in parallel (one file per partition); readers take the folder.
    """
    sub = pred.select(F.col(key), clip01(col).alias(out))
    sub.write.mode("overwrite").option("header", True).csv(path)
    schema = StructType([StructField(key, LongType()), StructField(out, DoubleType())])
    return pred.sparkSession.read.schema(schema).option("header", True).csv(path)


def rekey(template: DataFrame, pred: DataFrame, key: str = "row_id") -> DataFrame:
    """Put predictions on the ids of an existing submission (left join)."""
    return template.select(key).join(pred, on=key, how="left")


def fold_done(spark: SparkSession, path: str, model: str) -> list[int]:
    """Folds of ``model`` already checkpointed (reads partition values only)."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        return []  # nothing written yet
    rows = df.where(F.col("model") == model).select("fold").distinct().collect()
    return sorted(int(r["fold"]) for r in rows)


def checkpoint_fold(pred: DataFrame, path: str, model: str, fold: int) -> None:
    """Store every output of one fold (OOF and test rows) or nothing.

    ``pred`` holds ``row_id, kind ('oof'|'test'), pred``; the fold's partition
    is overwritten as a unit (dynamic partition overwrite), so a retried fold
    replaces, never duplicates, and a crash leaves the fold absent.
    """
    (pred.select("row_id", "kind", "pred")
     .withColumns({"model": F.lit(model), "fold": F.lit(int(fold))})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("model", "fold").parquet(path))


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the store that holds ``path``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def commit(spark: SparkSession, home: str, parts: dict[str, DataFrame], model=None) -> None:
    """Write ``parts`` (name -> rows) and a model under ``home``, all or nothing.

    Everything goes to a folder beside it, whose rename is the commit; a job that dies before leaves no ``home``, and of two
    that race the first stays.
    """
    parent, _, name = home.rstrip("/").rpartition("/")
    own = f"{parent}/_writing-{name}-{uuid.uuid4().hex[:12]}"
    for part, df in parts.items():
        df.write.parquet(f"{own}/{part}")
    if model is not None:
        model.write().save(f"{own}/model")
    fs, at = _fs(spark, own)
    to = _fs(spark, home)[1]
    if fs.exists(to) or not fs.rename(at, to):
        fs.delete(at, True)
        if not fs.exists(to):
            raise OSError(f"could not rename {own} to {home}")


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The rows of several committed parts of one schema."""
    return spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)


def recover_predictions(spark: SparkSession, path: str, model: str) -> tuple[DataFrame, DataFrame]:
    """OOF = union of each fold's own rows; test = mean over folds per row."""
    p = spark.read.parquet(path).where(F.col("model") == model)
    oof = p.where(F.col("kind") == "oof").select("row_id", "fold", "pred")
    test = p.where(F.col("kind") == "test").groupBy("row_id").agg(
        F.avg("pred").alias("pred"), F.count(F.lit(1)).alias("n_folds"))
    return oof, test


def load_first(spark: SparkSession, paths: Sequence[str]) -> tuple[str, DataFrame]:
    """A10: the first path that holds a readable parquet table; raises if none."""
    errors = []
    for p in paths:
        try:
            df = spark.read.parquet(p)
            df.schema  # resolves the file listing
            return p, df
        except AnalysisException as e:
            if not _absent(e):
                raise
            errors.append(f"{p}: {e.getCondition()}")  # try the next version
    raise FileNotFoundError("no prediction version found: " + "; ".join(errors))
