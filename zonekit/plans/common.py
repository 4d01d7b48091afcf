"""Shared inputs for registered queries: the bound view with keys and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import stored
from ..sources.fixtures import zone_obs
from .pipeline import with_keys


def keyed(spark: SparkSession, sf_dir: str, folds: int = 5) -> DataFrame:
    return with_keys(zone_obs(spark, sf_dir), folds)


def keyed_split(spark: SparkSession, sf_dir: str, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    z = keyed(spark, sf_dir, folds)
    return z.where("split = 'train'"), z.where("split = 'test'")


_TIER_VERSION, _FILE_ROWS = "v2", 500_000


def fold_files(df: DataFrame, name: str) -> DataFrame:
    """``df`` as files that fold jobs read again at each pass (``files=True``), as those of :func:`tier2`."""
    return stored(df, name, file_rows=_FILE_ROWS)


def tier2(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tier-2 train/test features, written once per input folder to the shared
    folder and re-read afterwards (the reference's tier files).

    The folder's name holds the input files with their sizes and times, so changed input is computed anew. A
    run writes to a folder of its own and then renames it, so jobs that race or die leave no half-written tables.
    """
    import hashlib
    from ..session import scratch_path, shared_dir
    from .pipeline import features
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    sfs = source.getFileSystem(conf)
    status = sfs.listStatus(source)
    state = [f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in status]
    tag = hashlib.sha1("|".join([_TIER_VERSION, *sorted(state)]).encode()).hexdigest()[:16]
    base = f"{shared_dir(spark)}/zonekit/tier2-{tag}"
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        own = scratch_path(spark, "tier2")
        tr, te = keyed_split(spark, sf_dir)
        ftr, fte = features(tr, te)
        for part, df in (("train", ftr), ("test", fte)):
            # files that one task can read whole: columns compress to some 34 bytes a row
            df.write.option("maxRecordsPerFile", _FILE_ROWS).parquet(f"{own}/{part}")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(own), path) and not fs.exists(path):
            raise OSError(f"could not rename {own} to {base}")
    return spark.read.parquet(f"{base}/train"), spark.read.parquet(f"{base}/test")
