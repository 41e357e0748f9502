"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "textmill", memory: str = "12g") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only where the session names none (tests, a laptop) is a fresh local one made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="textmill-")
        _written.append(folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Folders written by this process, which removes them when it ends or when ``release`` is called.
_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, owned by this process."""
    if not _written:
        atexit.register(_release_at_exit)
    _written.append(os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}"))
    return _written[-1]


def release(spark: SparkSession) -> None:
    """Remove the written tables; frames made before the call can no longer be read."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for folder in _written:
        path = paths(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _written.clear()


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        release(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: survives the loss of executors.

    Unlike ``checkpoint`` this computes the table once, and its size is known to later plans.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition a table that many passes will read: one part per core at least, and never fewer than the scan has."""
    parts = max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts, *cols)


def spread_few(df: DataFrame, *cols: str) -> DataFrame:
    """Spread a scan that has fewer parts than there are cores, such as one small file.

    A scan of many files has more parts than cores and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *cols)
