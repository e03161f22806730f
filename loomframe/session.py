"""Session settings and the shared folder used for files that must outlive a task."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loomframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE, skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def configured_root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local temporary folder is used only where the setting is missing and the master is local.
    """
    configured = configured_root(spark)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="loomframe-")
    return _LOCAL_ROOTS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/loomframe-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; frames read from there end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/loomframe-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative estimators somewhere reliable to cut their lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result is computed once, survives the loss of executors and has no lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialise` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if f"/loomframe-{spark.sparkContext.applicationId}/" in folder:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def training_width() -> int:
    """Tasks the active session runs at once: the width of training steps whose estimator wants a number."""
    return max(1, SparkSession.getActiveSession().sparkContext.defaultParallelism)


def balanced(scan: DataFrame) -> DataFrame:
    """A file scan with at least as many partitions as the cluster has cores.

    A table in few row groups would keep most cores idle through the per-row work up to the first shuffle, or
    through every pass of a training loop. Scans that are wide enough, as large tables are, stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


# Rows of a training table in one task, at most about.
TASK_ROWS = 500_000


def bounded(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in parts of about ``rows`` rows where it has more.

    Tree learners keep their table in memory as it is dealt, decoded: a file split of 128 MB of packed columns, or a
    large row group, is many times that.
    """
    parts = math.ceil(df.count() / rows)
    return df.repartition(parts) if parts > 1 else df


@contextmanager
def persisted(*frames: DataFrame):
    """Keep frames that several jobs read in memory (spilling to disk), then let them go."""
    held = [frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames]
    try:
        yield held[0] if len(held) == 1 else tuple(held)
    finally:
        for frame in held:
            frame.unpersist()
