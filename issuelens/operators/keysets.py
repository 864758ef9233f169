"""Comparing sets of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """Every key of either side with its status: local_only, remote_only or in_sync."""
    left = local.select(key).distinct().withColumn("_local", F.lit(True))
    right = remote.select(key).distinct().withColumn("_remote", F.lit(True))
    status = (
        F.when(F.col("_remote").isNull(), "local_only")
        .when(F.col("_local").isNull(), "remote_only")
        .otherwise("in_sync")
    )
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def missing_remotely(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """Keys that still have to be sent."""
    return local.select(key).distinct().join(remote.select(key), key, "left_anti")


def common_keys(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    return local.select(key).intersect(remote.select(key))


def open_issues(latest: int, done: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Issues still to fetch: failed ones as `retry`, numbers 1..latest never seen as `pending`.

    A key that is both done and failed counts as failed.
    """
    spark = done.sparkSession
    bad = failed.select(F.col(key).cast("bigint").alias(key)).distinct()
    seen = done.select(F.col(key).cast("bigint").alias(key)).unionByName(bad)
    every = spark.range(1, latest + 1).select(F.col("id").alias(key))
    never = every.join(seen, key, "left_anti").withColumn("status", F.lit("pending"))
    return bad.withColumn("status", F.lit("retry")).unionByName(never)
