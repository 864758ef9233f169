"""Operators that need one global order, without ever sending all rows to one task.

Rows are range-partitioned and sorted, each gets its position inside its range, and
only one row per range (its size, its maximum) is combined across ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.session import materialize

# monotonically_increasing_id() keeps the partition number above this bit and counts rows below it.
ROW_BITS = 33


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """Sorted ranges of `df` with `_range` (number of the range) and `_row` (position in it).

    Written once, because range borders come from a sample and would differ on recomputation.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    slot = F.col("_slot")
    placed = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()))
    return placed.select(
        *df.columns,
        F.shiftright(slot, ROW_BITS).alias("_range"),
        slot.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )


def _before_each_range(ranges: DataFrame, total, combine) -> DataFrame:
    """One row per range with the combination of `total` over all earlier ranges.

    The window sees one row per range, never the data, so its size is the number of partitions.
    """
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranges.groupBy("_range").agg(total.alias("_total"))
    return per_range.select("_range", combine("_total").over(earlier).alias("_before"))


def with_global_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the order of `order` (which must be unique)."""
    ranges = in_ranges(df, order)
    before = _before_each_range(ranges, F.count(F.lit(1)), F.sum)
    return ranges.join(F.broadcast(before), "_range").select(
        *df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_row")).alias(name)
    )


def with_group_position(df: DataFrame, group: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row inside its group, whatever the size of the group.

    A window over the group would put a group that holds a third of the rows into one task.
    """
    indexed = with_global_index(df, [*group, *order], "_index")
    first = indexed.groupBy(*group).agg(F.min("_index").alias("_first"))
    return indexed.join(first, group).select(*df.columns, (F.col("_index") - F.col("_first")).alias(name))


def slice_borders(df: DataFrame, column: str, size: int, least: int, few: int) -> list:
    """Values of `column` that cut it into slices of about `size` rows; at most one value per slice reaches the driver.

    Small tables are cut into up to `few` slices of at least `least` rows, so that they keep several tasks.
    """
    rows = df.count()
    slices = max(rows // size, min(few, rows // least))
    if slices < 2:
        return []
    shares = [k / slices for k in range(1, slices)]
    found = df.agg(F.percentile_approx(column, shares, max(10000, 10 * slices)).alias("borders")).first().borders
    return sorted(set(found or []))


def slice_number(column: Column, borders: list) -> Column:
    """Number of borders up to the value, by bisection; -1 for null, which sorts first."""
    if not borders:
        return F.when(column.isNull(), -1).otherwise(0)
    values = F.lit(borders)
    steps = F.lit([1 << k for k in reversed(range(len(borders).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(values, at + step - 1) <= column, at + step).otherwise(at))
    return F.when(column.isNull(), -1).otherwise(found)


def rows_before(df: DataFrame, group: list[str], number: str) -> DataFrame:
    """Rows (group, number, `_before`, `_rows`, `_total`): of each group the rows in lower slices, in this one and in all.

    The windows see one row per group and slice.
    """
    per_slice = df.groupBy(*group, number).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_total": F.sum("_rows").over(Window.partitionBy(*group)),
        }
    )


def every_kth(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """Every k-th row in order, with the smallest k that leaves at most `most` rows."""
    indexed = with_global_index(df, order, "_index")
    step = indexed.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(most)), F.lit(1)).alias("k")).scalar()
    return indexed.where(F.col("_index") % step == 0).drop("_index")


def running_max(df: DataFrame, order: list[str], value: str, name: str = "best_so_far") -> DataFrame:
    """Add the largest `value` up to and including each row in the order of `order`."""
    ranges = in_ranges(df, order)
    before = _before_each_range(ranges, F.max(value), F.max)
    so_far = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return ranges.join(F.broadcast(before), "_range").select(
        *df.columns, F.greatest(F.max(value).over(so_far), F.col("_before")).alias(name)
    )


def with_running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of `value` up to and including each row in the order of `order` (which must be unique)."""
    ranges = in_ranges(df, order)
    before = _before_each_range(ranges, F.sum(value), F.sum)
    so_far = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return ranges.join(F.broadcast(before), "_range").select(
        *df.columns, (F.sum(value).over(so_far) + F.coalesce("_before", F.lit(0))).alias(name)
    )
