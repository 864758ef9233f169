"""From nested issue documents to rows, and from rows to the tables made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.moments import epoch_to_utc
from issuelens.functions.text import field_if_object
from issuelens.operators.dedup import keep_first
from issuelens.schemas import METRICS, ROW_KEY


def issues_with_content(raw: DataFrame) -> DataFrame:
    """Issues that have a header or at least one video."""
    header = F.coalesce(F.to_json("config"), F.lit("{}")) != "{}"
    return raw.where(header | (F.size(F.coalesce("videos", F.array())) > 0))


def issue_headers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("number"),
        F.col("config.subject").alias("subject"),
        F.col("config.name").alias("name"),
        F.col("config.label").alias("label"),
        F.col("config.cover").alias("cover"),
        F.col("config.stime").alias("stime"),
        F.col("config.etime").alias("etime"),
    )


def video_rows(raw: DataFrame) -> DataFrame:
    """One flat row per video of each issue, named by (week_number, pos).

    An issue without videos gives no row. An issue may come in several documents; then
    `first_pos` says how many videos the earlier ones hold.
    """
    start = F.col("first_pos") if "first_pos" in raw.columns else F.lit(0)
    exploded = raw.select(
        F.col("number").alias("week_number"),
        F.col("config.subject").alias("week_subject"),
        F.col("config.name").alias("week_name"),
        F.col("config.stime").alias("week_stime"),
        start.cast("bigint").alias("_start"),
        F.posexplode("videos").alias("_i", "v"),
    )
    plain = [
        "aid", "bvid", "title", "desc", "duration", "pubdate", "cid", "pic", "short_link_v2", "copyright",
        "tid", "tname", "tidv2", "tnamev2", "pid_v2", "pid_name_v2", "dynamic", "rcmd_reason",
    ]
    return exploded.select(
        "week_number",
        (F.col("_start") + F.col("_i")).alias("pos"),
        "week_subject",
        "week_name",
        "week_stime",
        *[F.col(f"v.{c}").alias(c) for c in plain],
        F.col("v.owner.mid").alias("mid"),
        F.col("v.owner.name").alias("up_name"),
        F.col("v.owner.face").alias("face"),
        F.coalesce("v.stat.aid", "v.aid").alias("stat_aid"),
        *[F.col(f"v.stat.{m}").alias(m) for m in METRICS],
        F.col("v.dimension.width").alias("width"),
        F.col("v.dimension.height").alias("height"),
        (F.coalesce("v.rights.pay", F.lit(0)) != 0).cast("int").alias("is_pay"),
        field_if_object(F.col("v.rcmd_reason"), "tid_v2", "bigint").alias("reason_tid_v2"),
        field_if_object(F.col("v.rcmd_reason"), "tname_v2").alias("reason_tname_v2"),
    )


def weekly_table(headers: DataFrame) -> DataFrame:
    return headers.select(
        "number", "subject", "name", F.col("stime").alias("start_time"), F.col("etime").alias("end_time")
    )


def split_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The four per-video tables as projections of one frame; they share the row key."""
    return {
        "Video": rows.select(*ROW_KEY, "aid", "bvid", "title", "desc", "duration", "pubdate", "cid", "pic"),
        "Creator": rows.select(*ROW_KEY, "mid", F.col("up_name").alias("name"), "face"),
        "Category": rows.select(
            *ROW_KEY,
            "tid",
            "tname",
            F.col("reason_tid_v2").alias("tid_v2"),
            F.col("reason_tname_v2").alias("tname_v2"),
        ),
        "VideoStat": rows.select(*ROW_KEY, F.col("stat_aid").alias("aid"), *METRICS),
    }


def weekly_records(headers: DataFrame) -> DataFrame:
    return headers.select(
        "number", "subject", "name", "label", "cover",
        epoch_to_utc(F.col("stime")).alias("start_time"),
        epoch_to_utc(F.col("etime")).alias("end_time"),
    )


def normalised_records(rows: DataFrame) -> dict[str, DataFrame]:
    """The five record groups per issue; creators and categories once per issue, first seen wins.

    Every group keeps weekly_number, so later steps can join on (weekly_number, aid).
    """
    week = F.col("week_number").alias("weekly_number")

    def once_per_issue(key: str) -> DataFrame:
        return keep_first(rows.where(F.col(key).isNotNull()), ["week_number", key], ["pos"])

    return {
        "creators": once_per_issue("mid").select(week, "mid", F.col("up_name").alias("name"), "face"),
        "categories": once_per_issue("tid").select(
            week, "tid", "tname",
            F.col("tidv2").alias("tid_v2"), F.col("tnamev2").alias("tname_v2"), "pid_v2", "pid_name_v2",
        ),
        "videos": rows.select(
            week, "pos", "aid", "bvid", "title", F.col("desc").alias("description"), "duration",
            epoch_to_utc(F.col("pubdate")).alias("pubdate"), "cid",
            F.col("short_link_v2").alias("video_url"), F.col("pic").alias("cover_url"), "copyright",
            F.col("mid").alias("creator_mid"), F.col("tid").alias("category_tid"),
        ),
        "video_stats": rows.select(
            week, "pos", F.col("stat_aid").alias("aid"), "view", F.col("like").alias("like_cnt"),
            "coin", "favorite", "share", "reply", "danmaku",
        ),
        "weekly_videos": rows.select(week, "pos", "aid"),
    }
