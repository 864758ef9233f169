"""Session settings and the checkpoint folder shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs expect; `extra` wins over them.

    Shuffle partitions and memory stay the caller's choice (spark-submit or
    `extra`), because they follow the cluster and the data, not this library.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's own, a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="issuelens-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder when the session's JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def materialize(df: DataFrame, name: str = "stored", compression: str | None = None) -> DataFrame:
    """Write `df` once as Parquet below the checkpoint folder and continue from the written rows.

    Used where a frame is read by several branches, or where its rows carry ids
    that must not change when a lost executor makes Spark recompute a stage. Reading it back
    prunes columns and pushes filters down. The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    remove_at_exit(spark, path)
    return spark.read.parquet(path)
