"""Keeping one or a few rows per key.

All of them filter row_number() against a constant, which Spark turns into a limit per key
before the shuffle: a key that holds a third of all rows sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: list[str], order: list[str | Column], n: int, rank: str | None = None) -> DataFrame:
    """The first `n` rows of each key; `rank` names a column that keeps their number."""
    name = rank or "_rank"
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_n(df, keys, order, 1)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_n(df, keys, [F.col(c).desc() for c in order], 1)


def last_value(value: str, order: list[str]) -> Column:
    """Aggregate: the last non-null value in the given order."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))


def latest_name(df: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
    """Dimension that overwrites: one row per non-null key with its last non-null name."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(last_value(name, order).alias(name))
