"""What the operators share: words, row identity, stored intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.session import ensure_checkpoint_dir, materialize

# A word is a run of code points other than these six white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage by a written table; survives lost executors."""
    return materialize(df, name)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors share; it goes when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def identified(docs: DataFrame, *carry: str) -> tuple[DataFrame, bool]:
    """(doc_id, tie, text) and the columns to carry, and whether every row has an id of its own.

    `tie` tells rows apart that share a doc_id or have none: it is 0 for all rows while ids are unique and a
    hash of the text otherwise, so that only equal rows stay equal.
    """
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    unique = not repeated.limit(1).count()
    tie = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", tie.alias("tie"), "text", *carry), unique
