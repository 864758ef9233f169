"""Schemas and fixed column lists of the issue documents and the tables made from them."""

from __future__ import annotations

RAW_ISSUE = """
number BIGINT,
config STRUCT<subject: STRING, name: STRING, label: STRING, cover: STRING, stime: BIGINT, etime: BIGINT>,
videos ARRAY<STRUCT<
  aid: BIGINT, bvid: STRING, title: STRING, desc: STRING, duration: BIGINT, pubdate: BIGINT,
  cid: BIGINT, pic: STRING, short_link_v2: STRING, copyright: INT,
  tid: BIGINT, tname: STRING, tidv2: BIGINT, tnamev2: STRING, pid_v2: INT, pid_name_v2: STRING,
  dynamic: STRING, rcmd_reason: STRING,
  owner: STRUCT<mid: BIGINT, name: STRING, face: STRING>,
  stat: STRUCT<aid: BIGINT, view: BIGINT, like: BIGINT, coin: BIGINT, favorite: BIGINT,
               share: BIGINT, reply: BIGINT, danmaku: BIGINT>,
  dimension: STRUCT<width: INT, height: INT>,
  rights: STRUCT<pay: INT>>>,
_corrupt_record STRING
"""

METRICS = ["view", "like", "coin", "favorite", "share", "reply", "danmaku"]

# One row of every table below belongs to one video of one issue and is named by this key.
ROW_KEY = ["week_number", "pos"]

TABLES = ["Weekly", "Video", "Creator", "Category", "VideoStat"]

# Columns that must have a value in each cleaned table, and the type they are stored with.
NUMERIC_TYPES = {
    "Weekly": {"number": "bigint", "start_time": "bigint", "end_time": "bigint"},
    "Video": {"aid": "bigint", "duration": "bigint", "pubdate": "bigint", "cid": "bigint"},
    "Creator": {"mid": "bigint"},
    "Category": {"tid": "bigint", "tid_v2": "bigint"},
    "VideoStat": {"aid": "bigint", **{m: "double" for m in METRICS}},
}
TEXT_COLUMNS = {
    "Weekly": ["subject", "name"],
    "Video": ["bvid", "title", "desc", "pic"],
    "Creator": ["name", "face"],
    "Category": ["tname", "tname_v2"],
    "VideoStat": [],
}

DWD_COLUMNS = [
    "weekly_number", "aid", "bvid", "title", "duration", "pubdate",
    "up_mid", "up_name", "category_tid", "category_name",
    "view", "like_cnt", "coin", "favorite", "share", "reply", "danmaku",
    "like_rate", "coin_rate", "favorite_rate",
]

# Cells of a video row that end up in the cleaned tables; the cleaning report counts the empty ones.
VIDEO_CELLS = [
    "aid", "bvid", "title", "desc", "duration", "pubdate", "cid", "pic",
    "mid", "up_name", "face",
    "tid", "tname", "reason_tid_v2", "reason_tname_v2",
    "stat_aid", *METRICS,
]
