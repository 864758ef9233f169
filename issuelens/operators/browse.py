"""Browse queries over the six normalised tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.functions.text import contains_search


@dataclass
class Library:
    weekly: DataFrame
    creator: DataFrame
    category: DataFrame
    video: DataFrame
    video_stat: DataFrame
    weekly_video: DataFrame


def _page_bounds(page: int, page_size: int) -> tuple[int, int]:
    size = max(1, min(page_size, 100))
    return (page - 1) * size, size


def video_summary(lib: Library, videos: DataFrame | None = None) -> DataFrame:
    """Each video with the names of its creator and category and its two main figures."""
    creator = lib.creator.select(F.col("mid").alias("creator_mid"), F.col("name").alias("creator_name"))
    category = lib.category.select(F.col("tid").alias("category_tid"), F.col("tname").alias("category_name"))
    figures = lib.video_stat.select("aid", "view", "like_cnt")
    return (
        (lib.video if videos is None else videos)
        .join(figures, "aid", "left")
        .join(creator, "creator_mid", "left")
        .join(category, "category_tid", "left")
    )


SUMMARY = [
    "aid", "bvid", "title", "cover_url", "duration", "pubdate", "creator_name", "category_name", "view", "like_cnt",
]


def weeks(lib: Library) -> DataFrame:
    counts = lib.weekly_video.groupBy(F.col("weekly_number").alias("number")).agg(F.count("aid").alias("_n"))
    return (
        lib.weekly.join(counts, "number", "left")
        .select(*lib.weekly.columns, F.coalesce("_n", F.lit(0)).alias("video_count"))
        .orderBy(F.desc("number"))
    )


def week_videos(lib: Library, week: int) -> DataFrame:
    """The videos of one issue, most viewed first."""
    listed = lib.weekly_video.where(F.col("weekly_number") == week).select("aid")
    videos = lib.video.join(listed, "aid")
    return video_summary(lib, videos).select(*SUMMARY).orderBy(F.desc_nulls_first("view"), "aid")


def filtered_videos(
    lib: Library,
    week: int | None = None,
    category: int | None = None,
    creator: int | None = None,
    search: str | None = None,
) -> DataFrame:
    """Videos that satisfy all given filters; the filters run before any join."""
    videos = lib.video
    if category is not None:
        videos = videos.where(F.col("category_tid") == category)
    if creator is not None:
        videos = videos.where(F.col("creator_mid") == creator)
    if search:
        videos = videos.where(contains_search(F.col("title"), search))
    if week is not None:
        videos = videos.join(lib.weekly_video.where(F.col("weekly_number") == week).select("aid"), "aid")
    return videos


VIDEO_ORDER = {"view": "view", "like": "like_cnt", "pubdate": "pubdate"}


def video_page(lib: Library, page: int = 1, page_size: int = 20, sort_by: str = "view", **filters) -> DataFrame:
    skip, size = _page_bounds(page, page_size)
    found = video_summary(lib, filtered_videos(lib, **filters)).select(*SUMMARY)
    by = VIDEO_ORDER.get(sort_by, "view")
    return found.orderBy(F.desc_nulls_first(by), "aid").offset(skip).limit(size)


def _behind(by: str, key: str, value, last: int) -> Column:
    """Rows that follow (value, last) in the order by descending `by`, missing values first, then ascending key."""
    tied = F.col(by).eqNullSafe(F.lit(value)) & (F.col(key) > last)
    return tied | (F.col(by).isNotNull() if value is None else F.col(by) < F.lit(value))


def video_page_after(lib: Library, after: tuple | None = None, page_size: int = 20, sort_by: str = "view", **filters) -> DataFrame:
    """The page that follows the row `after` = (its sort value, its aid); the first page without it.

    No task keeps more than a page of rows, however deep the page lies; `video_page` keeps all rows before it as well.
    """
    size = _page_bounds(1, page_size)[1]
    by = VIDEO_ORDER.get(sort_by, "view")
    found = video_summary(lib, filtered_videos(lib, **filters)).select(*SUMMARY)
    if after is not None:
        found = found.where(_behind(by, "aid", *after))
    return found.orderBy(F.desc_nulls_first(by), "aid").limit(size)


def video_total(lib: Library, **filters) -> DataFrame:
    """Number of videos over all pages; the names and figures need not be joined for it."""
    return filtered_videos(lib, **filters).agg(F.count(F.lit(1)).alias("total"))


def video_detail(lib: Library, aid: int) -> DataFrame:
    """One video with all its figures and the issues it appeared in, newest first; empty if unknown."""
    one = F.col("aid") == aid
    creator = lib.creator.select(
        F.col("mid").alias("creator_mid"), F.col("name").alias("creator_name"), F.col("face").alias("creator_face")
    )
    category = lib.category.select(
        F.col("tid").alias("category_tid"), F.col("tname").alias("category_name"),
        F.col("tname_v2").alias("category_v2_name"),
    )
    # At most one entry per issue, since (weekly_number, aid) is the key of the bridge.
    issues = lib.weekly_video.where(one).groupBy("aid").agg(
        F.sort_array(F.collect_set("weekly_number"), asc=False).alias("appeared_weeks")
    )
    return (
        lib.video.where(one)
        .join(lib.video_stat.where(one), "aid", "left")
        .join(creator, "creator_mid", "left")
        .join(category, "category_tid", "left")
        .join(issues, "aid", "left")
    )


def _creator_totals(lib: Library, videos: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Per creator: distinct listed videos, and sums that count a video once per appearance.

    The appearances are counted per video before the join, so rows are not multiplied.
    """
    listed = lib.weekly_video.groupBy("aid").agg(F.count(F.lit(1)).alias("_times"))
    figures = lib.video_stat.select("aid", *totals.values())
    joined = videos.select("aid", "creator_mid").join(figures, "aid", "left").join(listed, "aid", "left")
    times = F.coalesce("_times", F.lit(1))
    return joined.groupBy(F.col("creator_mid").alias("mid")).agg(
        F.count("_times").alias("video_count"),
        *[F.sum(F.col(c) * times).alias(name) for name, c in totals.items()],
        F.sum(totals["total_views"]).alias("unique_views"),
    )


def creators(lib: Library) -> DataFrame:
    totals = _creator_totals(lib, lib.video, {"total_views": "view"})
    return lib.creator.join(totals, "mid", "left").select(
        "mid", "name", "face", F.coalesce("video_count", F.lit(0)).alias("video_count"), "total_views", "unique_views"
    )


def creators_page(lib: Library, page: int = 1, page_size: int = 20, sort_by: str = "video_count") -> DataFrame:
    skip, size = _page_bounds(page, page_size)
    orders = {
        "video_count": F.desc_nulls_first("video_count"),
        "total_views": F.desc_nulls_first("total_views"),
        "name": F.asc_nulls_last("name"),
    }
    by = orders.get(sort_by, orders["video_count"])
    return creators(lib).orderBy(by, "mid").offset(skip).limit(size)


def creators_page_after(lib: Library, after: tuple | None = None, page_size: int = 20, sort_by: str = "video_count") -> DataFrame:
    """The page of creators that follows `after` = (video count or total views of its row, its mid)."""
    size = _page_bounds(1, page_size)[1]
    by = sort_by if sort_by in ("video_count", "total_views") else "video_count"
    found = creators(lib)
    if after is not None:
        found = found.where(_behind(by, "mid", *after))
    return found.orderBy(F.desc_nulls_first(by), "mid").limit(size)


def creators_total(lib: Library) -> DataFrame:
    return lib.creator.agg(F.count(F.lit(1)).alias("total"))


def creator_detail(lib: Library, mid: int) -> DataFrame:
    names = {"total_views": "view", "total_likes": "like_cnt", "total_coins": "coin", "total_favorites": "favorite"}
    totals = _creator_totals(lib, lib.video.where(F.col("creator_mid") == mid), names)
    return lib.creator.where(F.col("mid") == mid).join(totals, "mid", "left").select(
        "mid", "name", "face", F.coalesce("video_count", F.lit(0)).alias("video_count"), *names, "unique_views"
    )


def creator_videos(lib: Library, mid: int, top: int = 100) -> DataFrame:
    own = lib.video.where(F.col("creator_mid") == mid)
    return video_summary(lib, own).select(*SUMMARY).orderBy(F.desc_nulls_first("view"), "aid").limit(top)


def categories(lib: Library) -> DataFrame:
    counts = lib.video.groupBy(F.col("category_tid").alias("tid")).agg(F.count_distinct("aid").alias("_n"))
    return (
        lib.category.join(counts, "tid", "left")
        .select(*lib.category.columns, F.coalesce("_n", F.lit(0)).alias("video_count"))
        .orderBy(F.desc("video_count"), "tid")
    )
