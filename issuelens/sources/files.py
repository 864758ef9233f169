"""Reading issue documents, tables and word lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.schemas import RAW_ISSUE

# Words that never count as keywords; fixed values.
STOP_WORDS = (
    "的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 "
    "这 他 她 它 们 那 些 什么 怎么 如何 为什么 因为 所以 但是 可以 这个 那个 已经 还是 或者 如果 "
    "虽然 然后 而且 不过 只是 当然 《 》 之 — … · ~ 】 【 】 （ ） 第 期 万 亿 个 次 元 "
    "年 月 日"
).split()
# Blank tokens never count either; fixed values.
BLANK_WORDS = [" ", "", "\n", "\r", "\t"]


def scan_issues(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """All issue documents with the declared schema, plus the file and the issue number in its name.

    A file that is no valid document gives one row with its text in _corrupt_record.
    Order issues by `number`, never by file name.
    """
    raw = (
        spark.read.schema(RAW_ISSUE)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(paths)
    )
    return with_file_number(raw)


def with_file_number(raw: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"week_(\d+)", 1)
    return raw.select("*", name.alias("file_name"), F.when(number != "", number).try_cast("int").alias("file_number"))


def good_issues(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("_corrupt_record").isNull() & F.col("number").isNotNull())


def skipped_issues(raw: DataFrame) -> DataFrame:
    """Rows (week_number, error) of documents that could not be read; -1 if the name has no number."""
    broken = raw.where(F.col("_corrupt_record").isNotNull() | F.col("number").isNull())
    error = F.when(F.col("_corrupt_record").isNotNull(), "not a valid document").otherwise("no issue number")
    return broken.select(F.coalesce("file_number", F.lit(-1)).alias("week_number"), error.alias("error"))


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def is_ready(spark: SparkSession, folder: str, required: dict[str, list[str]]) -> bool:
    """Whether every table can be read and has the columns; only schemas are looked at."""
    for name, columns in required.items():
        try:
            present = scan_table(spark, folder, name).columns
        except AnalysisException:
            return False
        if not set(columns) <= set(present):
            return False
    return True


def scan_words(spark: SparkSession, path: str | None = None) -> DataFrame:
    """A list of words, one per line of a file, as the column `token`; blanks are always part of it."""
    known = BLANK_WORDS if path else [*STOP_WORDS, *BLANK_WORDS]
    words = spark.createDataFrame([(w,) for w in known], "token STRING")
    if path:
        words = words.unionByName(spark.read.text(path).select(F.col("value").alias("token")))
    return words.distinct()
