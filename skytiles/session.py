"""Session and scratch-space helpers.

Jobs that write intermediate tables (sink round trips, lineage cuts) put
them under the cluster's shared checkpoint folder, read from
``spark.checkpoint.dir``. A private folder is created only when the
session has none, which is the case for local tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "skytiles", **extra: str) -> SparkSession:
    """A local session configured the way the tests and the bench use it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local runs handle small data: keep several tasks per stage rather
        # than coalescing a few MB into one (per-file write costs add up).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # As many scan tasks as cores where the files can be split.
        .config("spark.sql.files.minPartitionNum", str(cores if cores != "*" else 8))
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set up if missing.

    Order: a directory already registered on the context, then the
    ``spark.checkpoint.dir`` setting, then - in local mode only, where
    driver and executors share one machine - a new temporary folder. On a
    cluster a machine-local folder would split the data across machines,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by "
                               "the cluster (intermediate tables are written there)")
        configured = tempfile.mkdtemp(prefix="skytiles-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes at its end the scratch paths handed out inside it. For jobs
    that finish their work; a frame that is read later must not depend on
    such a path."""
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes[:] = [own for own in _open_scopes if own is not paths]
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if fs.exists(where):
                fs.delete(where, True)


@contextlib.contextmanager
def scratch_scope_off():
    """Scratch paths handed out inside outlive the scopes around."""
    held = _open_scopes[:]
    _open_scopes.clear()
    try:
        yield
    finally:
        _open_scopes[:] = held


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, on any file system Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(where).getLength()


def write_scratch_table(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read
    it back. Cuts the lineage: later passes read the stored rows (only the
    columns they need) instead of recomputing them, and a lost executor
    costs only its own tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
