"""Three warehouse layers: detail fact (dwd), summaries (dws), application tables (ads)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.functions.rates import mean, rate
from issuelens.operators.dedup import keep_first, keep_last, last_value, latest_name
from issuelens.schemas import DWD_COLUMNS

COUNTS = ["view", "like_cnt", "coin", "favorite", "share", "reply", "danmaku"]
SUMS = {"total_views": "view", "total_likes": "like_cnt", "total_coins": "coin", "total_favorites": "favorite"}
IN_ORDER = ["weekly_number", "aid"]


def _typed_fact(rows: DataFrame) -> DataFrame:
    """Fill, rates and stored types; the rates need the filled counts."""
    filled = rows.na.fill(0, subset=[*COUNTS, "up_mid", "category_tid", "duration"])
    types = {c: "bigint" for c in [*COUNTS, "aid", "up_mid"]}
    types.update({c: "int" for c in ["weekly_number", "category_tid", "duration"]})
    typed = filled.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    rates = {f"{name}_rate": rate(col, zero="as_zero") for name, col in
             [("like", "like_cnt"), ("coin", "coin"), ("favorite", "favorite")]}
    return typed.withColumns(rates).select(*DWD_COLUMNS)


def fact_from_records(groups: dict[str, DataFrame]) -> DataFrame:
    """The fact out of the normalised record groups, one row per (weekly_number, aid).

    Bridge, videos and figures are joined on the whole grain. Joining on aid alone would
    multiply a video that appears in k issues to k*k*k rows. A video listed twice in one
    issue counts once, with its first entry. Names follow the latest issue.
    """
    grain = ["weekly_number", "aid"]

    def one(name: str) -> DataFrame:
        return keep_first(groups[name], grain, ["pos"]).drop("pos")

    creators = latest_name(groups["creators"], "mid", "name", ["weekly_number"])
    categories = latest_name(groups["categories"], "tid", "tname", ["weekly_number"])
    return _typed_fact(
        one("weekly_videos")
        .join(one("videos"), grain, "left")
        .join(one("video_stats"), grain, "left")
        .join(creators.select(F.col("mid").alias("creator_mid"), F.col("name").alias("up_name")), "creator_mid", "left")
        .join(categories.select(F.col("tid").alias("category_tid"), F.col("tname").alias("category_name")), "category_tid", "left")
        .withColumnRenamed("creator_mid", "up_mid")
    )


def fact_from_appearances(rows: DataFrame, creators: DataFrame, categories: DataFrame) -> DataFrame:
    """The same fact when each row already holds one (weekly_number, aid) with its figures.

    Only the two name dimensions are joined; no shuffle of the fact on its grain.
    """
    return _typed_fact(
        rows.join(creators.select("up_mid", "up_name"), "up_mid", "left")
        .join(categories.select("category_tid", "category_name"), "category_tid", "left")
    )


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(SUMS[n]).cast("bigint").alias(n) for n in names]


def _int_count(column: Column, name: str) -> Column:
    return column.cast("int").alias(name)


def dws_creator(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("up_mid")
        .agg(
            last_value("up_name", IN_ORDER).alias("up_name"),
            *_sums(list(SUMS)),
            mean("view", 2).alias("avg_view"),
            F.round(F.avg("like_rate"), 6).alias("avg_like_rate"),
            F.round(F.avg("coin_rate"), 6).alias("avg_coin_rate"),
            _int_count(F.count("aid"), "video_count"),
            _int_count(F.count_distinct("aid"), "unique_video_count"),
            F.min("weekly_number").alias("week_first"),
            F.max("weekly_number").alias("week_last"),
        )
        .withColumn("active_span", F.col("week_last") - F.col("week_first") + 1)
    )


def dws_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category_tid").agg(
        last_value("category_name", IN_ORDER).alias("category_name"),
        *_sums(["total_views"]),
        mean("view", 2).alias("avg_view_per_video"),
        F.round(F.avg("like_rate"), 6).alias("avg_like_rate"),
        _int_count(F.count("aid"), "video_count"),
        _int_count(F.count_distinct("up_mid"), "unique_creator_count"),
    )


def dws_weekly(fact: DataFrame) -> DataFrame:
    return fact.groupBy("weekly_number").agg(
        *_sums(["total_views"]),
        mean("view", 2).alias("avg_view_per_video"),
        _int_count(F.count("aid"), "video_count"),
        _int_count(F.count_distinct("up_mid"), "creator_count"),
        _int_count(F.count_distinct("category_tid"), "category_count"),
        *_sums(["total_likes", "total_coins", "total_favorites"]),
    )


def ads_hot_videos(fact: DataFrame) -> DataFrame:
    """Each video with its last appearance, most viewed first."""
    columns = [
        "aid", "bvid", "title", "up_mid", "up_name", "category_name",
        "view", "like_cnt", "coin", "favorite", "like_rate", "coin_rate", "pubdate",
    ]
    return keep_last(fact, ["aid"], ["weekly_number"]).select(*columns).orderBy(F.desc("view"), "aid")


def ads_top_creators(creators: DataFrame) -> DataFrame:
    columns = [
        "up_mid", "up_name", "total_views", "avg_like_rate", "avg_coin_rate",
        "video_count", "unique_video_count", "active_span",
    ]
    return creators.select(*columns).orderBy(F.desc("total_views"), "up_mid")


def ads_category_trend(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("category_name").isNotNull())
        .groupBy("weekly_number", "category_name")
        .agg(
            _int_count(F.count("aid"), "video_count"),
            *_sums(["total_views"]),
            F.round(F.avg("like_rate"), 6).alias("avg_like_rate"),
        )
        .orderBy("weekly_number", "category_name")
    )


def ads_weekly_kpi(weekly: DataFrame, fact: DataFrame) -> DataFrame:
    rates = fact.groupBy("weekly_number").agg(
        F.round(F.avg("like_rate"), 6).alias("avg_like_rate"),
        F.round(F.avg("coin_rate"), 6).alias("avg_coin_rate"),
    )
    kept = ["weekly_number", "total_views", "avg_view_per_video", "video_count", "creator_count", "category_count"]
    return (
        weekly.select(*kept)
        .join(rates, "weekly_number", "left")
        .na.fill(0.0, subset=["avg_like_rate", "avg_coin_rate"])
        .orderBy("weekly_number")
    )
