"""Range join: the issue whose period holds a moment."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Moments that are missing match nothing; they are spread over this many keys, so they meet in no single task.
EMPTY_KEYS = 1024
# Buckets that one task sweeps together.
SPAN = 256


def _sweep(pieces: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one span as disjoint segments, each with the number of the first piece by rank that covers it.

    A sweep over the starts and ends in ascending order, with the open pieces in a heap by rank.
    """
    pieces = pieces.sort_values("_start", kind="stable")
    starts, ends = pieces["_start"].tolist(), pieces["_end"].tolist()
    ranks, numbers = pieces["_rank"].tolist(), pieces["_number"].tolist()
    edges = sorted({*starts, *(e + 1 for e in ends)})
    opened: list[tuple[int, int]] = []
    at, rows = 0, []
    for low, high in zip(edges, edges[1:]):
        while at < len(starts) and starts[at] <= low:
            heapq.heappush(opened, (ranks[at], at))
            at += 1
        while opened and ends[opened[0][1]] < low:
            heapq.heappop(opened)
        if not opened:
            continue
        number = numbers[opened[0][1]]
        if rows and rows[-1][1] == low - 1 and rows[-1][2] == number:
            rows[-1][1] = high - 1
        else:
            rows.append([low, high - 1, number])
    return pd.DataFrame(rows, columns=["_start", "_end", "_number"])


def disjoint_periods(
    calendar: DataFrame, order: list[str], start: str = "start_time", end: str = "end_time", number: str = "number",
    bucket: int = 86_400,
) -> DataFrame:
    """Rows (_bucket, _start, _end, _number): the calendar as segments that do not overlap, each under every bucket it touches.

    A segment names the first period, in the order of `order`, that covers it. A missing bound counts as 0, a period
    that ends before it starts holds nothing. A task sees the periods that touch one span of SPAN buckets.
    """
    first, last = F.coalesce(start, F.lit(0)).cast("bigint"), F.coalesce(end, F.lit(0)).cast("bigint")
    width = bucket * SPAN
    pieces = calendar.where((first <= last) & F.col(number).isNotNull()).select(
        F.col(number).cast("bigint").alias("_number"), *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
        first.alias("_first"), last.alias("_last"), F.explode(F.sequence(F.floor(first / width), F.floor(last / width))).alias("_span"),
    )
    by_order = Window.partitionBy("_span").orderBy(*[f"_order{i}" for i in range(len(order))], "_number")
    cut = pieces.select(
        "_span", "_number", F.row_number().over(by_order).alias("_rank"),
        F.greatest("_first", F.col("_span") * width).alias("_start"),
        F.least("_last", F.col("_span") * width + (width - 1)).alias("_end"),
    )
    segments = cut.groupBy("_span").applyInPandas(_sweep, "_start LONG, _end LONG, _number LONG")
    touched = F.sequence(F.floor(F.col("_start") / bucket), F.floor(F.col("_end") / bucket))
    return segments.select(F.explode(touched).alias("_bucket"), "_start", "_end", "_number")


def match_issue(
    videos: DataFrame,
    calendar: DataFrame,
    moment: str,
    order: list[str],
    start: str = "start_time",
    end: str = "end_time",
    number: str = "number",
    out: str = "week_number",
    default: int = 1,
    bucket: int = 86_400,
) -> DataFrame:
    """Add the first issue, in calendar order, with start <= moment <= end; `default` if none.

    The calendar becomes disjoint segments per bucket of `bucket` seconds, so a moment meets one segment at most and the
    range test is one equi-join on the bucket: no distinct moments, no join back. Missing moments get keys that no
    bucket has. Moments and bounds are whole seconds.
    """
    segments = disjoint_periods(calendar, order, start, end, number, bucket)
    nowhere = F.struct(F.lit(None).cast("bigint").alias("bucket"), F.pmod(F.xxhash64(*videos.columns), F.lit(EMPTY_KEYS)).alias("spread"))
    at = F.struct(F.floor(F.col(moment) / bucket).alias("bucket"), F.lit(0).cast("bigint").alias("spread"))
    keyed = videos.withColumn("_at", F.when(F.col(moment).isNull(), nowhere).otherwise(at))
    sought = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).cast("bigint").alias("spread"))
    inside = F.col(moment).between(F.col("_start"), F.col("_end"))
    joined = keyed.join(segments.withColumn("_sought", sought), (F.col("_at") == F.col("_sought")) & inside, "left")
    return joined.select(*videos.columns, F.coalesce("_number", F.lit(default)).cast("int").alias(out))
