"""Report statistics over cleaned videos.

Input rows carry aid, mid, creator_name, tname, week_number, like and the other metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.rates import mean, rate
from issuelens.schemas import ROW_KEY

RATES = {"like_rate": "like", "coin_rate": "coin", "favorite_rate": "favorite"}


def join_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per video out of the five cleaned tables."""
    creator = tables["Creator"].select(*ROW_KEY, "mid", F.col("name").alias("creator_name"))
    category = tables["Category"].select(*ROW_KEY, "tname")
    issue = tables["Weekly"].select(F.col("number").alias("week_number")).distinct()
    return (
        tables["Video"]
        .join(tables["VideoStat"].drop(*ROW_KEY), "aid")
        .join(creator, ROW_KEY, "left")
        .join(category, ROW_KEY, "left")
        .join(issue, "week_number")
    )


def with_rates(videos: DataFrame) -> DataFrame:
    return videos.withColumns({name: rate(part, zero="as_one") for name, part in RATES.items()})


def overall(videos: DataFrame) -> DataFrame:
    metrics = ["view", "like", "coin", "favorite", "share", "danmaku"]
    return with_rates(videos).agg(
        F.count("aid").alias("total_videos"),
        F.count_distinct("mid").alias("total_creators"),
        *[mean(m, 2).alias(f"avg_{m}") for m in metrics],
        *[F.round(F.avg(r), 4).alias(f"avg_{r}") for r in RATES],
    )


def _group_means(videos: DataFrame, key: str) -> DataFrame:
    return (
        with_rates(videos)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("aid").alias("video_count"),
            mean("view", 2).alias("avg_view"),
            mean("like", 2).alias("avg_like"),
            F.round(F.avg("like_rate"), 4).alias("avg_interaction_rate"),
        )
    )


def by_category(videos: DataFrame) -> DataFrame:
    return _group_means(videos, "tname")


def by_week(videos: DataFrame) -> DataFrame:
    return _group_means(videos, "week_number").orderBy("week_number")


def by_creator(videos: DataFrame, top: int = 10) -> DataFrame:
    """The creators with most appearances; ties in the order of mid."""
    totals = {"total_view": "view", "total_like": "like", "total_favorite": "favorite"}
    return (
        videos.where(F.col("mid").isNotNull() & F.col("creator_name").isNotNull())
        .groupBy("mid", "creator_name")
        .agg(
            F.count("aid").alias("appearance_count"),
            *[F.sum(m).cast("bigint").alias(name) for name, m in totals.items()],
        )
        .orderBy(F.desc("appearance_count"), "mid")
        .limit(top)
    )


def weekly_series(videos: DataFrame) -> DataFrame:
    """One point per issue: means of four metrics and the number of videos."""
    return (
        videos.where(F.col("week_number") > 0)
        .groupBy("week_number")
        .agg(
            *[mean(m).alias(f"avg_{m}") for m in ["view", "like", "coin", "favorite"]],
            F.count("aid").alias("video_count"),
        )
    )
