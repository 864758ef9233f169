"""Cleaning steps on rows and on the tables split from them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.operators.dedup import keep_first
from issuelens.schemas import METRICS, NUMERIC_TYPES, ROW_KEY, TEXT_COLUMNS, VIDEO_CELLS


def null_counts(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column_name, null_count), from one pass over the data."""
    columns = columns or df.columns
    counts = df.agg(*null_counts(columns))
    return counts.unpivot([], columns, "column_name", "null_count")


def fill_missing(df: DataFrame, table: str) -> DataFrame:
    """Zero for missing numbers and "" for missing texts of a known table."""
    numbers = {c: 0 for c in NUMERIC_TYPES[table] if c in df.columns and c != "number"}
    texts = {c: "" for c in TEXT_COLUMNS[table] if c in df.columns}
    return df.na.fill({**numbers, **texts})


def convert_types(df: DataFrame, table: str) -> DataFrame:
    """The stored type of every numeric column; a value that is no number becomes null."""
    types = NUMERIC_TYPES[table]
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def no_negative_metrics(metrics: list[str] = METRICS) -> Column:
    return reduce(and_, [F.col(m) >= 0 for m in metrics])


def drop_negative(df: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    return df.where(no_negative_metrics(metrics))


def keep_rows_of(table: DataFrame, survivors: DataFrame, key: list[str] = ROW_KEY) -> DataFrame:
    """Rows of a partner table whose key is still among the survivors."""
    return table.join(survivors.select(*key), key, "left_semi")


def drop_infinite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose listed numbers are all present and finite."""
    floating = [c for c, t in df.dtypes if c in columns and t in ("double", "float")]
    finite = {c: F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.col(c)) for c in floating}
    return df.withColumns(finite).na.drop(subset=columns)


def clean_rows(rows: DataFrame, order: list[str] = ROW_KEY) -> DataFrame:
    """Rows after cleaning: known video, first appearance only, missing metrics 0, none negative.

    Works before the split into tables, so the five tables stay in step without any join.
    """
    known = rows.where(F.col("aid").isNotNull())
    filled = known.na.fill({m: 0 for m in METRICS if m in rows.columns})
    return drop_negative(keep_first(filled, ["aid"], order), [m for m in METRICS if m in rows.columns])


def cleaning_counts(rows: DataFrame, headers: DataFrame, order: list[str] = ROW_KEY) -> DataFrame:
    """One row with the numbers of the cleaning report.

    One aggregation per video gives the fate of its first appearance, a second one adds up;
    both combine on the map side, so neither a popular video nor the null id is a bottleneck.
    """
    present = [m for m in METRICS if m in rows.columns]
    filled = [F.coalesce(m, F.lit(0)) for m in present]
    negative = reduce(lambda a, b: a | b, [c < 0 for c in filled])
    missing = _empty_cells(VIDEO_CELLS)
    per_video = (
        rows.select("aid", "week_number", F.struct(*order).alias("_at"), negative.alias("_neg"), missing.alias("_missing"))
        .groupBy("aid")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            F.min_by("_neg", "_at").alias("_neg"),
            F.sum("_missing").alias("_missing"),
        )
    )
    known = F.col("aid").isNotNull()
    issues = headers.groupBy("number").agg(F.min(_empty_cells(["subject", "name", "stime", "etime"])).alias("_missing"))
    header_cells = issues.agg(F.sum("_missing").alias("n")).scalar()
    return per_video.agg(
        F.count_if(known & ~F.col("_neg")).alias("total_videos"),
        F.sum(F.when(known, F.col("seen") - 1).otherwise(0)).alias("duplicates_dropped"),
        F.sum("_missing").alias("_missing"),
        F.count_if(known & F.col("_neg")).alias("outliers_flagged"),
    ).select(
        issues.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_weeks"),
        "total_videos",
        F.coalesce("duplicates_dropped", F.lit(0)).alias("duplicates_dropped"),
        (F.coalesce("_missing", F.lit(0)) + F.coalesce(header_cells, F.lit(0))).alias("missing_filled"),
        "outliers_flagged",
    )


def _empty_cells(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in columns])
