"""Session construction and lineage helpers.

Cluster settings (checkpoint folder, shuffle partitions, memory) belong to
whoever launches the job; this module only fills in what is missing, which
is what local runs and tests need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers over TCP wait some 40 ms per task for a delayed acknowledgement
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillcast") -> SparkSession:
    """Return the active session or build one with sane analytics defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at ``spark.checkpoint.dir``.

    On a cluster the launcher names a shared folder there and it is used
    as-is. Only when the setting is absent on a local master (tests) is a
    scratch folder created; on a cluster executors could not see it, so the
    missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tillcast-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


# rows go to Python in batches of at most so many rows, 10,000 by default, whatever their size
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on a batch of rows for Python ends at about ``size`` bytes, unless the launcher names a size: a task of
    long texts else holds the same 10,000 texts in Spark's buffers and in the worker."""
    if not spark.sparkContext.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, size)


# removes the shuffle files of a SQL execution when it ends; else they stay until the driver collects its garbage
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCOPES: list[list[str]] = []


def materialize(df: DataFrame, name: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage the way ``checkpoint()`` does, but columnar: later
    reads prune columns and push filters, the size is known to the planner,
    and a lost executor costs nothing but the tasks it was running. The
    shuffle files of the write go with it. Inside ``temporary_tables`` the table goes
    when the innermost scope ends, with ``keep`` when the one around it does.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    scopes = _SCOPES[:-1] if keep else _SCOPES
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are removed at the end: nothing read later may depend on them."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A written copy of ``df``, for tables that several branches or fits read."""
    return materialize(df, "tillcast")
