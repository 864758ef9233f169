"""Exploratory aggregations over cleaned videos with a positive view count."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.functions.buckets import duration_group, equal_width_bin
from issuelens.functions.moments import minutes, publish_fields
from issuelens.functions.rates import mean, rate, total
from issuelens.functions.text import short_label
from issuelens.operators.dedup import keep_first

SEVEN_METRICS = ["view", "like", "coin", "favorite", "share", "danmaku", "reply"]


def base_clean(rows: DataFrame, order: list[str]) -> DataFrame:
    """First appearance of each known video, if it has views."""
    known = rows.where(F.col("aid").isNotNull())
    return keep_first(known, ["aid"], order).where(F.col("view") > 0)


def with_time_fields(videos: DataFrame) -> DataFrame:
    fields = publish_fields(F.col("pubdate"))
    return videos.withColumns({**fields, "duration_min": minutes("duration")})


def category_stats(videos: DataFrame) -> DataFrame:
    return (
        videos.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            mean("view", 0).alias("avg_view"),
            mean("like", 0).alias("avg_like"),
            F.sum("view").alias("total_view"),
        )
        .orderBy(F.desc("video_count"), "category")
    )


def top_videos(videos: DataFrame, top: int = 20) -> DataFrame:
    return videos.orderBy(F.desc("view"), "aid").limit(top)


def creator_rank(videos: DataFrame, by: str = "appear_count", top: int = 15) -> DataFrame:
    return (
        videos.groupBy("mid", "creator_name")
        .agg(
            F.count(F.lit(1)).alias("appear_count"),
            F.sum("view").alias("total_view"),
            mean("view", 0).alias("avg_view"),
            F.sum("like").alias("total_like"),
        )
        .orderBy(F.desc(by), "mid")
        .limit(top)
    )


def correlations_with(videos: DataFrame, target: str, others: list[str]) -> DataFrame:
    """Rows (metric, correlation): Pearson correlation of `target` with each other metric, one pass."""
    wide = videos.agg(*[F.round(F.corr(target, m), 4).alias(m) for m in others])
    return wide.unpivot([], others, "metric", "correlation")


def correlation_matrix(videos: DataFrame, metrics: list[str]) -> DataFrame:
    """All ordered pairs (metric_a, metric_b, correlation); every pair comes from one aggregation."""
    pairs = list(combinations(metrics, 2))
    cells = [
        F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.round(F.corr(a, b), 4).alias("correlation"))
        for a, b in pairs
    ]
    ones = [
        F.struct(F.lit(m).alias("metric_a"), F.lit(m).alias("metric_b"), F.lit(1.0).alias("correlation")) for m in metrics
    ]
    half = videos.agg(F.array(*cells).alias("upper")).select(
        F.explode(
            F.concat(
                F.col("upper"),
                F.transform(
                    "upper",
                    lambda c: F.struct(
                        c.metric_b.alias("metric_a"), c.metric_a.alias("metric_b"), c.correlation.alias("correlation")
                    ),
                ),
                F.array(*ones),
            )
        ).alias("cell")
    )
    return half.select("cell.*")


def describe(videos: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column_name, n, mean, stddev, min, max) from one aggregation."""
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.round(F.avg(c), 4).alias("mean"),
            F.round(F.stddev_samp(c), 4).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return videos.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def with_duration_group(videos: DataFrame) -> DataFrame:
    return videos.withColumn("_group", duration_group(F.col("duration_min"))).select(*videos.columns, "_group.*")


def duration_stats(videos: DataFrame) -> DataFrame:
    return (
        with_duration_group(videos)
        .groupBy("duration_group", "duration_order")
        .agg(
            F.count(F.lit(1)).alias("count"),
            *[mean(m, 0).alias(f"avg_{m}") for m in ["view", "like", "coin"]],
        )
        .orderBy("duration_order")
        .drop("duration_order")
    )


def yearly_trend(videos: DataFrame) -> DataFrame:
    return (
        videos.groupBy("pub_year")
        .agg(
            F.count(F.lit(1)).alias("video_count"),
            mean("view", 0).alias("avg_view"),
            mean("like", 0).alias("avg_like"),
            F.round(F.avg("duration_min"), 1).alias("avg_duration"),
            F.count_distinct("mid").alias("unique_creators"),
        )
        .orderBy("pub_year")
    )


def engagement_by_category(videos: DataFrame, at_least: int = 50, top: int | None = None) -> DataFrame:
    """Mean coin, favorite and like rates in percent for categories with enough videos."""
    parts = {"coin": "coin", "fav": "favorite", "like": "like"}
    out = (
        videos.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("count"),
            *[
                F.round(F.avg(rate(col, zero="null")) * 100, 3).alias(f"avg_{name}_rate_pct")
                for name, col in parts.items()
            ],
        )
        .where(F.col("count") >= at_least)
        .orderBy(F.desc("avg_coin_rate_pct"), "category")
    )
    return out.limit(top) if top else out


def category_avg_view(videos: DataFrame, at_least: int = 50, top: int = 15) -> DataFrame:
    return (
        videos.groupBy("category")
        .agg(mean("view", 0).alias("avg_view"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= at_least)
        .orderBy(F.desc("avg_view"), "category")
        .limit(top)
    )


def with_engagement(videos: DataFrame) -> DataFrame:
    """Rates of all reactions to views, and of the three main ones (interaction)."""
    interaction = total("like", "coin", "favorite")
    return (
        videos.withColumn("interaction", interaction)
        .withColumn("_all", total("like", "coin", "favorite", "share", "danmaku"))
        .withColumn("engagement_rate", rate("_all", zero="null"))
        .withColumn("interaction_rate", rate("interaction", zero="as_one"))
        .drop("_all")
    )


def top_by_sum(rows: DataFrame, key: str, value: str, top: int, name: str) -> DataFrame:
    """The `top` keys with the largest sum of a value."""
    return rows.groupBy(key).agg(F.sum(value).alias(name)).orderBy(F.desc(name), key).limit(top)


def histogram(rows: DataFrame, value: str | Column, bins: int = 50) -> DataFrame:
    """Rows (bin, low, n) of equal-width bins between the smallest and largest value; empty bins are left out."""
    values = rows.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v")).where("v IS NOT NULL")
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low, high = span.select("lo").scalar(), span.select("hi").scalar()
    counted = values.groupBy(equal_width_bin(F.col("v"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / F.lit(float(bins))
    return counted.select("bin", (low + F.col("bin") * width).alias("low"), "n")


def share_of_total(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per key as a share of the grand total, largest first; an all-zero total counts as 1."""
    sums = rows.groupBy(key).agg(F.sum(value).alias("amount"))
    grand = sums.agg(F.sum("amount").alias("t")).scalar()
    share = F.col("amount").cast("double") / F.when(grand == 0, F.lit(1)).otherwise(grand)
    return sums.select(key, "amount", F.round(share, 6).alias("share")).orderBy(F.desc("share"), key)


def top_and_other(rows: DataFrame, key: str, top: int = 12, other: str = "other") -> DataFrame:
    """Counts of the `top` most frequent keys under short labels, and of all the others together."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    leaders = counts.orderBy(F.desc("n"), key).limit(top)
    label = short_label(F.col(key).cast("string")).alias("label")
    named = leaders.select(label, F.col("n").alias("video_count"))
    rest = counts.join(leaders.select(key), key, "left_anti").agg(F.sum("n").alias("video_count"))
    others = rest.where("video_count > 0").select(F.lit(other).alias("label"), "video_count")
    return named.unionByName(others)


def zscores(rows: DataFrame, columns: list[str], key: list[str], population: bool = False) -> DataFrame:
    """Columns minus their mean, divided by their standard deviation (sample or population)."""
    spread = F.stddev_pop if population else F.stddev_samp
    # One pass for all statistics; its single row is bound as constants.
    stats = rows.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[spread(c).alias(f"s_{c}") for c in columns]
    ).first()
    z = [((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"])).alias(f"z_{c}") for c in columns]
    return rows.select(*key, *z)


def one_hot(rows: DataFrame, column: str, levels: list, prefix: str) -> DataFrame:
    """0/1 column per level except the first in order, which the others imply."""
    flags = [(F.col(column) == F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in sorted(levels)[1:]]
    return rows.select("*", *flags)

