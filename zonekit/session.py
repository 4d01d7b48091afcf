"""Spark session and shared-folder helpers.

Settings chosen for the target cluster: AQE on (runtime broadcast choice by
measured size, partition coalescing, skew-join splitting), UTC session time,
Arrow for the few pandas hand-offs, UI off.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    # checkpoint files of running-sum tables are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, partitions: int = 8, app: str = "zonekit",
              extra: dict | None = None, driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session with the defaults above.

    On a cluster the launcher owns master and memory; locally tests pass
    ``master='local[8]'``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(partitions)
    if driver_memory:  # local mode: the driver JVM is the executor
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a private
    folder is created and registered, so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="zonekit-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


_HOMES: set[str] = set()


def _remove(spark: SparkSession, home: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except (Py4JError, OSError, AttributeError):
        pass  # the session ended before: nothing can be reached any more


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for tables a job writes, in a folder of the application's own.

    The folder is removed when the application ends by itself; one that was killed leaves it under its application id.
    """
    home = f"{shared_dir(spark)}/zonekit/{spark.sparkContext.applicationId}"
    if home not in _HOMES:
        _HOMES.add(home)
        atexit.register(_remove, spark, home)
    return f"{home}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str, compression: str | None = None, file_rows: int = 0):
    """Write ``df`` to the shared folder and read it again: computed once, its lineage cut; it survives lost executors.

    ``file_rows``: rows a file holds at most (0: any number).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SPLIT_CONF, _SPLIT = "spark.sql.files.maxPartitionBytes", 24 << 20
_FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_setting, _users = threading.Lock(), {}


def _bytes(size: str) -> int:
    """Bytes of a setting: 134217728b, 128MB, 1g."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def _set(spark: SparkSession, conf: str, value, *default: str):
    """``conf`` is ``value`` of its own setting (``default``: where Spark has none) inside; that returns when the last user leaves."""
    at = (id(spark), conf)
    with _setting:
        n, own = _users.get(at, (0, None))
        if not n:
            own = spark.conf.get(conf, *default)
            spark.conf.set(conf, value(own))
        _users[at] = (n + 1, own)
    try:
        yield
    finally:
        with _setting:
            n, own = _users.pop(at)
            if n > 1:
                _users[at] = (n - 1, own)
            else:
                spark.conf.set(conf, own)


def finer_splits(spark: SparkSession):
    """Files that jobs read inside it come in splits of at most 24 MB; the session's own setting returns when the last user leaves.

    A split of 128 MB holds millions of rows where columns compress well: too few tasks for the cores, and too many rows in one.
    """
    return _set(spark, _SPLIT_CONF, lambda own: str(min(_SPLIT, _bytes(own))))


def freed_shuffles(spark: SparkSession):
    """Queries that end inside it remove their shuffle files at once, on all executors; otherwise these stay until the driver's JVM
    happens to collect the plans. For passes over large rows whose results are small or written. A stage that is read again is computed again.
    """
    return _set(spark, _FREE_CONF, lambda own: "true", "false")


def dropped(df) -> None:
    """Remove the tables of :func:`stored` that ``df`` reads and nothing else will; other files stay."""
    bare = lambda path: "/" + path.removeprefix("file:").lstrip("/")
    home = bare(f"{shared_dir(df.sparkSession)}/zonekit/{df.sparkSession.sparkContext.applicationId}/")
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if bare(path).startswith(home):
            _remove(df.sparkSession, path)


def default_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
