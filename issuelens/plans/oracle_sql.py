"""SQL equivalents of the registered queries over the plain test tables."""

from __future__ import annotations

ORD = "l_orderkey, l_linenumber, aid, l_suppkey, l_extendedprice, l_shipdate"
METRICS = ["view", "like", "coin", "favorite", "share", "reply", "danmaku"]
COUNTS = ["view", "like_cnt", "coin", "favorite", "share", "reply", "danmaku"]


def names(columns, template="{c}"):
    return ", ".join(template.format(c=c) for c in columns)


RAW = """raw AS (
  SELECT CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INT) AS week_number,
    l_partkey AS aid, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate,
    p_name AS title, CAST(p_size * 90 AS INT) AS duration, o_orderdate AS pubdate, o_orderpriority AS reason,
    l_suppkey AS mid, s_name AS creator_name, p_type AS tname, p_brand AS sub_category,
    CAST('0x' || substr(md5(p_type), 1, 7) AS INT) AS tid,
    CAST(floor(l_extendedprice) AS BIGINT) AS view, CAST(l_quantity * 100 AS BIGINT) AS like_cnt,
    CAST(round(l_discount * 1000) AS BIGINT) AS coin, CAST(round(l_tax * 1000) AS BIGINT) AS favorite,
    CAST(l_linenumber AS BIGINT) AS share, CAST(p_size AS BIGINT) AS reply, l_orderkey % 100 AS danmaku,
    p_size * 10 AS width, (p_size % 5) * 10 AS height,
    CAST(epoch(date_trunc('month', l_shipdate)) AS BIGINT) AS stime,
    CAST(epoch(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH) AS BIGINT) - 1 AS etime,
    'Issue ' || CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS VARCHAR) AS subject,
    strftime(l_shipdate, '%Y-%m') AS week_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
FIRST = RAW + f""", first AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number, {ORD}) = 1)"""
BASE = FIRST + """, base AS (
  SELECT * EXCLUDE (like_cnt, tname), like_cnt AS "like", tname AS category FROM first WHERE view > 0)"""
APP = RAW + f""", app AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY week_number, aid ORDER BY {ORD}) = 1)"""
LAST = APP + """, last AS (
  SELECT * FROM app QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number DESC) = 1)"""
GAP_COLUMNS = """CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -1
      WHEN l_orderkey % 97 = 0 THEN 0 ELSE view END AS view,
    CASE WHEN l_orderkey % 107 <> 0 THEN aid END AS aid,
    CASE WHEN l_orderkey % 89 <> 0 THEN title END AS title"""
GAPS = RAW + f""", gaps AS (
  SELECT * EXCLUDE (view, aid, title), aid AS part, {GAP_COLUMNS} FROM raw)"""
NESTED_COLUMNS = """CAST(pos AS BIGINT) AS pos, 'BV' || CAST(aid AS VARCHAR) AS bvid,
    sub_category || ' ' || tname AS "desc", CAST(epoch(pubdate) AS BIGINT) AS pub_epoch,
    CASE WHEN l_orderkey % 10 <> 0 THEN aid ELSE aid END AS stat_aid"""
ROWS = RAW + f""", placed AS (
  SELECT *, row_number() OVER (PARTITION BY week_number ORDER BY {ORD}) - 1 AS pos FROM raw),
rws AS (SELECT * EXCLUDE (pos, like_cnt), like_cnt AS "like", {NESTED_COLUMNS} FROM placed)"""
GAP_ROWS = RAW + f""", placed AS (
  SELECT *, row_number() OVER (PARTITION BY week_number ORDER BY {ORD}) - 1 AS pos FROM raw),
gapped AS (SELECT * EXCLUDE (view, aid, title), {GAP_COLUMNS} FROM placed),
rws AS (SELECT * EXCLUDE (pos, like_cnt), like_cnt AS "like", {NESTED_COLUMNS} FROM gapped),
kept AS (SELECT * FROM (SELECT * FROM rws WHERE aid IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number, pos) = 1)
  WHERE coalesce(view, 0) >= 0)"""

RATED = """rated AS (SELECT *, CAST(like_cnt AS DOUBLE) / CASE WHEN view = 0 THEN 1 ELSE view END AS like_rate,
    CAST(coin AS DOUBLE) / CASE WHEN view = 0 THEN 1 ELSE view END AS coin_rate,
    CAST(favorite AS DOUBLE) / CASE WHEN view = 0 THEN 1 ELSE view END AS favorite_rate FROM first)"""


def mean(column, digits=None):
    out = f'CAST(sum("{column}") AS DOUBLE) / count("{column}")'
    return out if digits is None else f"round({out}, {digits})"


def total(column, alias):
    return f'CAST(sum("{column}") AS BIGINT) AS {alias}'


def group_means(key):
    return f"""WITH {FIRST}, {RATED} SELECT {key}, count(aid) AS video_count, {mean("view", 2)} AS avg_view,
      {mean("like_cnt", 2)} AS avg_like, round(avg(like_rate), 4) AS avg_interaction_rate FROM rated GROUP BY {key}"""


ORACLES: dict[str, str] = {}

# ---- statistics ----

ORACLES["stats_overall"] = f"""WITH {FIRST}, {RATED} SELECT count(aid) AS total_videos, count(DISTINCT mid) AS total_creators,
  {mean("view", 2)} AS avg_view, {mean("like_cnt", 2)} AS avg_like, {mean("coin", 2)} AS avg_coin,
  {mean("favorite", 2)} AS avg_favorite, {mean("share", 2)} AS avg_share, {mean("danmaku", 2)} AS avg_danmaku,
  round(avg(like_rate), 4) AS avg_like_rate, round(avg(coin_rate), 4) AS avg_coin_rate,
  round(avg(favorite_rate), 4) AS avg_favorite_rate FROM rated"""
ORACLES["stats_by_category"] = group_means("tname")
ORACLES["stats_by_week"] = group_means("week_number")
ORACLES["stats_by_creator"] = f"""WITH {FIRST} SELECT mid, creator_name, count(aid) AS appearance_count,
  {total("view", "total_view")}, {total("like_cnt", "total_like")}, {total("favorite", "total_favorite")}
  FROM first GROUP BY mid, creator_name ORDER BY appearance_count DESC, mid LIMIT 10"""
SERIES = APP + f""", series AS (SELECT week_number, {mean("view")} AS avg_view, {mean("like_cnt")} AS avg_like,
  {mean("coin")} AS avg_coin, {mean("favorite")} AS avg_favorite, count(aid) AS video_count
  FROM app WHERE week_number > 0 GROUP BY week_number)"""
ORACLES["weekly_series"] = f"""WITH {SERIES} SELECT week_number, video_count,
  {names(["view", "like", "coin", "favorite"], "round(avg_{c}, 4) AS avg_{c}")} FROM series"""

# ---- exploration ----

ORACLES["base_clean"] = f"""WITH {GAPS}, one AS (SELECT * FROM gaps WHERE aid IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY aid ORDER BY week_number, l_orderkey, l_linenumber, part, l_suppkey, l_extendedprice, l_shipdate) = 1)
  SELECT aid, week_number, l_orderkey, l_linenumber, view, title FROM one WHERE view > 0"""
ORACLES["dedup_first"] = f"WITH {FIRST} SELECT aid, week_number, l_orderkey, l_linenumber, title, view FROM first"
ORACLES["time_fields"] = """SELECT event_id, strftime(ts, '%Y-%m-%d') AS pub_date, CAST(year(ts) AS INT) AS pub_year,
  CAST(month(ts) AS INT) AS pub_month, CAST(hour(ts) AS INT) AS publish_hour, CAST(isodow(ts) - 1 AS INT) AS publish_weekday,
  round(floor(value) / 60.0, 1) AS duration_min FROM events"""
ORACLES["category_stats"] = f"""WITH {BASE} SELECT category, count(*) AS video_count, {mean("view", 0)} AS avg_view,
  {mean("like", 0)} AS avg_like, {total("view", "total_view")} FROM base GROUP BY category"""
ORACLES["top_videos"] = f"""WITH {BASE} SELECT aid, title, category, creator_name, strftime(pubdate, '%Y-%m-%d') AS pub_date,
  view, "like", coin, favorite, share, round(duration / 60.0, 1) AS duration_min FROM base ORDER BY view DESC, aid LIMIT 20"""
for _name, _by in [("creator_rank", "appear_count"), ("creator_rank_by_view", "total_view")]:
    ORACLES[_name] = f"""WITH {BASE} SELECT mid, creator_name, count(*) AS appear_count, {total("view", "total_view")},
      {mean("view", 0)} AS avg_view, {total("like", "total_like")} FROM base GROUP BY mid, creator_name
      ORDER BY {_by} DESC, mid LIMIT 15"""
ORACLES["corr_view"] = f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, round(corr(view, "{m}"), 4) AS correlation FROM base""" for m in METRICS[1:]
)
ORACLES["corr_matrix"] = f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{a}' AS metric_a, '{b}' AS metric_b, {"1.0::DOUBLE" if a == b else f'round(corr("{a}", "{b}"), 4)'} AS correlation FROM base"""
    for a in METRICS
    for b in METRICS
).replace("1.0::DOUBLE AS correlation FROM base", "CAST(1.0 AS DOUBLE) AS correlation")
ORACLES["describe_metrics"] = f"WITH {BASE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count("{c}") AS n, round(avg("{c}"), 4) AS mean, round(stddev_samp("{c}"), 4) AS stddev,
      CAST(min("{c}") AS DOUBLE) AS min, CAST(max("{c}") AS DOUBLE) AS max FROM base"""
    for c in [*METRICS, "duration"]
)
GROUPED = """grouped AS (SELECT *, round(duration / 60.0, 1) AS duration_min,
  CASE WHEN duration_min <= 1 THEN 1 WHEN duration_min <= 3 THEN 2 WHEN duration_min <= 5 THEN 3 WHEN duration_min <= 10 THEN 4
    WHEN duration_min <= 20 THEN 5 WHEN duration_min <= 60 THEN 6 ELSE 7 END AS duration_order,
  CASE duration_order WHEN 1 THEN '0-1 min' WHEN 2 THEN '1-3 min' WHEN 3 THEN '3-5 min' WHEN 4 THEN '5-10 min'
    WHEN 5 THEN '10-20 min' WHEN 6 THEN '20-60 min' ELSE '60+ min' END AS duration_group FROM base)"""
ORACLES["duration_buckets"] = f"WITH {BASE}, {GROUPED} SELECT aid, duration, duration_min, duration_group, duration_order FROM grouped"
ORACLES["duration_stats"] = f"""WITH {BASE}, {GROUPED} SELECT duration_group, count(*) AS count, {mean("view", 0)} AS avg_view,
  {mean("like", 0)} AS avg_like, {mean("coin", 0)} AS avg_coin FROM grouped GROUP BY duration_group"""
ORACLES["yearly_trend"] = f"""WITH {BASE} SELECT CAST(year(pubdate) AS INT) AS pub_year, count(*) AS video_count,
  {mean("view", 0)} AS avg_view, {mean("like", 0)} AS avg_like, round(avg(round(duration / 60.0, 1)), 1) AS avg_duration,
  count(DISTINCT mid) AS unique_creators FROM base GROUP BY 1"""
ORACLES["engagement_by_category"] = f"""WITH {BASE} SELECT category, count(*) AS count,
  round(avg(CAST(coin AS DOUBLE) / view) * 100, 3) AS avg_coin_rate_pct,
  round(avg(CAST(favorite AS DOUBLE) / view) * 100, 3) AS avg_fav_rate_pct,
  round(avg(CAST("like" AS DOUBLE) / view) * 100, 3) AS avg_like_rate_pct
  FROM base GROUP BY category HAVING count(*) >= 50"""
ORACLES["category_avg_view"] = f"""WITH {BASE} SELECT category, {mean("view", 0)} AS avg_view, count(*) AS n FROM base
  GROUP BY category HAVING count(*) >= 50 ORDER BY avg_view DESC, category LIMIT 15"""
ORACLES["engagement_rate"] = f"""WITH {BASE} SELECT aid, "like" + coin + favorite AS interaction,
  round(CAST("like" + coin + favorite + share + danmaku AS DOUBLE) / view, 6) AS engagement_rate,
  round(CAST("like" + coin + favorite AS DOUBLE) / view, 6) AS interaction_rate FROM base"""
ORACLES["top_creators_by_view"] = f"""WITH {RAW} SELECT creator_name, {total("view", "total_view")} FROM raw
  GROUP BY creator_name ORDER BY total_view DESC, creator_name LIMIT 10"""
ORACLES["histogram_view"] = """WITH span AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 50.0 AS w FROM events)
  SELECT bin, round(lo + bin * w, 6) AS low, n FROM (
    SELECT least(CAST(floor((value - lo) / CASE WHEN w = 0 THEN 0.01 ELSE w END) AS INT), 49) AS bin, count(*) AS n
    FROM events, span WHERE value IS NOT NULL GROUP BY 1) AS counted, span"""
ORACLES["category_share"] = f"""WITH {RAW} SELECT tname, {total("view", "amount")},
  round(CAST(sum(view) AS DOUBLE) / CAST(sum(sum(view)) OVER () AS DOUBLE), 6) AS share FROM raw GROUP BY tname"""
ORACLES["top_n_other"] = f"""WITH {RAW}, counted AS (SELECT sub_category, count(*) AS n,
    row_number() OVER (ORDER BY count(*) DESC, sub_category) AS r FROM raw GROUP BY sub_category)
  SELECT CASE WHEN length(sub_category) > 6 THEN substr(sub_category, 1, 5) || '…' ELSE sub_category END AS label, n AS video_count
  FROM counted WHERE r <= 12
  UNION ALL SELECT 'other', CAST(sum(n) AS BIGINT) FROM counted WHERE r > 12 HAVING sum(n) > 0"""
ORACLES["zscore_metrics"] = f"WITH {BASE} SELECT aid, " + ", ".join(
    f'round(("{c}" - avg("{c}") OVER ()) / stddev_samp("{c}") OVER (), 6) AS z_{c}' for c in ["view", "like", "coin", "favorite"]
) + " FROM base"
ORACLES["one_hot_weekday"] = "SELECT event_type, " + ", ".join(
    f"count(*) FILTER (WHERE isodow(ts) = {d + 1}) AS weekday_{d}" for d in range(1, 7)
) + " FROM events GROUP BY event_type"
ORACLES["running_best"] = """SELECT o_orderkey, o_totalprice, max(o_totalprice) OVER (
  ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM orders"""
ORACLES["sample_per_group"] = f"""WITH {FIRST} SELECT aid, tname, CAST(rank AS INT) AS rank FROM (
  SELECT aid, tname, row_number() OVER (PARTITION BY tname ORDER BY aid) AS rank FROM first) WHERE rank <= 20"""
ORACLES["downsample_every_kth"] = """WITH numbered AS (SELECT event_id, user_id, value, row_number() OVER (ORDER BY event_id) - 1 AS i,
    greatest(CAST(ceil(count(*) OVER () / 5000.0) AS BIGINT), 1) AS step FROM events)
  SELECT event_id, user_id, value FROM numbered WHERE i % step = 0"""

# ---- scans, nested documents, tables, record groups ----

ORACLES["scan_parquet"] = """SELECT l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem WHERE l_quantity >= 49 GROUP BY l_linestatus"""
QUOTED = names(METRICS, '"{c}"')
ORACLES["flatten_videos"] = f"""WITH {ROWS} SELECT week_number, pos, subject AS week_subject, week_name, stime AS week_stime, aid, bvid,
  title, CAST(tid AS BIGINT) AS tid, tname AS category, sub_category, pub_epoch AS pubdate, CAST(duration AS BIGINT) AS duration,
  reason AS rcmd_reason, mid, creator_name AS up_name, {QUOTED} FROM rws"""
ORACLES["split_weekly"] = f"""WITH {RAW} SELECT DISTINCT CAST(week_number AS BIGINT) AS number, subject, week_name AS name,
  stime AS start_time, etime AS end_time FROM raw"""
KEY = "CAST(week_number AS BIGINT) AS week_number, pos"
TEXT_NULL = "CAST(NULL AS VARCHAR)"
ORACLES["split_video"] = f"""WITH {ROWS} SELECT {KEY}, aid, bvid, title, "desc", CAST(duration AS BIGINT) AS duration,
  pub_epoch AS pubdate, l_orderkey AS cid, {TEXT_NULL} AS pic FROM rws"""
ORACLES["split_creator"] = f"WITH {ROWS} SELECT {KEY}, mid, creator_name AS name, {TEXT_NULL} AS face FROM rws"
ORACLES["split_category"] = f"""WITH {ROWS} SELECT {KEY}, CAST(tid AS BIGINT) AS tid, tname, CAST(NULL AS BIGINT) AS tid_v2,
  {TEXT_NULL} AS tname_v2 FROM rws"""
ORACLES["split_stat"] = f"WITH {ROWS} SELECT {KEY}, aid, {QUOTED} FROM rws"
ORACLES["split_video_clean"] = f"""WITH {GAP_ROWS} SELECT {KEY}, aid, bvid, coalesce(title, '') AS title, "desc",
  CAST(duration AS BIGINT) AS duration, pub_epoch AS pubdate, l_orderkey AS cid, '' AS pic FROM kept"""
ORACLES["split_creator_clean"] = f"WITH {GAP_ROWS} SELECT {KEY}, mid, creator_name AS name, '' AS face FROM kept"
ORACLES["split_category_clean"] = f"""WITH {GAP_ROWS} SELECT {KEY}, CAST(tid AS BIGINT) AS tid, tname, CAST(0 AS BIGINT) AS tid_v2,
  '' AS tname_v2 FROM kept"""
ORACLES["split_stat_clean"] = f"""WITH {GAP_ROWS} SELECT {KEY}, aid,
  {names(METRICS, 'CAST(coalesce("{c}", 0) AS DOUBLE) AS "{c}"')} FROM kept"""
ORACLES["stats_joined_tables"] = f"""WITH {GAP_ROWS}, shown AS (SELECT *, coalesce(view, 0) AS seen FROM kept)
  SELECT tname, count(aid) AS video_count, round(CAST(sum(seen) AS DOUBLE) / count(*), 2) AS avg_view, {mean("like", 2)} AS avg_like,
    round(avg(CAST("like" AS DOUBLE) / CASE WHEN seen = 0 THEN 1 ELSE seen END), 4) AS avg_interaction_rate FROM shown GROUP BY tname"""
ORACLES["etl_weekly"] = f"""WITH {RAW} SELECT DISTINCT CAST(week_number AS BIGINT) AS number, subject, week_name AS name,
  {TEXT_NULL} AS label, {TEXT_NULL} AS cover, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS start_time,
  CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH - INTERVAL 1 SECOND AS TIMESTAMP) AS end_time FROM raw"""
WEEK = "CAST(week_number AS BIGINT) AS weekly_number"
ORACLES["etl_creators"] = f"""WITH {ROWS} SELECT {WEEK}, mid, creator_name AS name, {TEXT_NULL} AS face FROM rws
  QUALIFY row_number() OVER (PARTITION BY week_number, mid ORDER BY pos) = 1"""
ORACLES["etl_categories"] = f"""WITH {ROWS} SELECT {WEEK}, CAST(tid AS BIGINT) AS tid, tname,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(tid AS BIGINT) END AS tid_v2, tname AS tname_v2, CAST(NULL AS INT) AS pid_v2,
  sub_category AS pid_name_v2 FROM rws QUALIFY row_number() OVER (PARTITION BY week_number, tid ORDER BY pos) = 1"""
ORACLES["etl_videos"] = f"""WITH {ROWS} SELECT {WEEK}, pos, aid, bvid, title, "desc" AS description, CAST(duration AS BIGINT) AS duration,
  pubdate, l_orderkey AS cid, {TEXT_NULL} AS video_url, {TEXT_NULL} AS cover_url, 1 AS copyright, mid AS creator_mid,
  CAST(tid AS BIGINT) AS category_tid FROM rws"""
ORACLES["etl_stats"] = f"""WITH {ROWS} SELECT {WEEK}, pos, aid, view, "like" AS like_cnt, coin, favorite, share, reply, danmaku FROM rws"""
ORACLES["etl_bridge"] = f"WITH {ROWS} SELECT {WEEK}, pos, aid FROM rws"
ORACLES["json_probe"] = """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
  FROM events"""

# ---- cleaning ----

ORACLES["fill_missing"] = f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, coalesce(aid, 0) AS aid, coalesce(title, '') AS title,
  coalesce(view, 0) AS view FROM gaps"""
ORACLES["null_profile"] = f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM gaps" for c in ["aid", "title", "creator_name", "view", "like_cnt"]
)
ORACLES["convert_types"] = f"""WITH {RAW} SELECT l_orderkey, l_linenumber, aid,
  CASE WHEN l_orderkey % 50 <> 0 THEN CAST(view AS DOUBLE) END AS view FROM raw"""
ORACLES["drop_negative_metrics"] = f"""WITH {GAPS} SELECT week_number, count(*) AS n, CAST(sum(coalesce(view, 0)) AS BIGINT) AS total_view
  FROM gaps WHERE coalesce(view, 0) >= 0 AND {names([c for c in COUNTS if c != "view"], "{c} >= 0").replace(",", " AND")}
  GROUP BY week_number"""
ORACLES["clean_report"] = f"""WITH {GAP_ROWS}, one AS (SELECT * FROM rws WHERE aid IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number, pos) = 1)
  SELECT (SELECT count(DISTINCT week_number) FROM rws) AS total_weeks, (SELECT count(*) FROM kept) AS total_videos,
    (SELECT count(aid) FROM rws) - (SELECT count(*) FROM one) AS duplicates_dropped,
    (SELECT CAST(sum(4 + 2 * CAST(aid IS NULL AS INT) + CAST(aid IS NULL AS INT) + CAST(title IS NULL AS INT)
       + CAST(view IS NULL AS INT)) AS BIGINT) FROM rws) AS missing_filled,
    (SELECT count(*) FROM one WHERE view < 0) AS outliers_flagged"""
ORACLES["trim_outliers"] = f"""WITH {RAW}, usable AS (SELECT * FROM raw WHERE view > 100 AND duration > 0),
  trimmed AS (SELECT * FROM usable WHERE view <= (SELECT quantile_cont(view, 0.995) FROM usable))
  SELECT aid, week_number, l_orderkey, view FROM trimmed
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number DESC, {ORD.replace(",", " DESC,")} DESC) = 1"""
ORACLES["range_match_issue"] = f"""WITH {RAW}, calendar AS (SELECT DISTINCT week_number AS number, stime, etime FROM raw WHERE week_number % 13 <> 0)
  SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS pubdate, coalesce(min(number), 1) AS week_number
  FROM orders LEFT JOIN calendar ON epoch(o_orderdate) BETWEEN stime AND etime GROUP BY o_orderkey, o_orderdate"""

# ---- warehouse ----


def fact_rate(column):
    return f"CASE WHEN view > 0 THEN CAST({column} AS DOUBLE) / view ELSE 0.0 END"


FACT = APP + f""", fact AS (SELECT week_number AS weekly_number, aid, 'BV' || CAST(aid AS VARCHAR) AS bvid, title, duration, pubdate,
  mid AS up_mid, creator_name AS up_name, tid AS category_tid, tname AS category_name, {names(COUNTS)},
  {fact_rate("like_cnt")} AS like_rate, {fact_rate("coin")} AS coin_rate, {fact_rate("favorite")} AS favorite_rate FROM app)"""
NINE = names(["like_rate", "coin_rate", "favorite_rate"], "round({c}, 9) AS {c}")
ORACLES["dwd_fact"] = f"""WITH {FACT} SELECT * EXCLUDE (like_rate, coin_rate, favorite_rate), {NINE} FROM fact"""
ORACLES["dwd_fact_from_records"] = ORACLES["dwd_fact"]
ORACLES["type1_dimension"] = f"""WITH {RAW} SELECT mid, name FROM (SELECT mid, week_number, {ORD},
    creator_name || '-' || CAST(CAST(floor((week_number - 1) / 12) AS BIGINT) AS VARCHAR) AS name FROM raw WHERE week_number % 7 <> 0)
  QUALIFY row_number() OVER (PARTITION BY mid ORDER BY week_number DESC, {ORD.replace(",", " DESC,")} DESC) = 1"""
DWS_CREATOR = f"""SELECT up_mid, max(up_name) AS up_name, {total("view", "total_views")}, {total("like_cnt", "total_likes")},
  {total("coin", "total_coins")}, {total("favorite", "total_favorites")}, {mean("view", 2)} AS avg_view,
  round(avg(like_rate), 6) AS avg_like_rate, round(avg(coin_rate), 6) AS avg_coin_rate, CAST(count(aid) AS INT) AS video_count,
  CAST(count(DISTINCT aid) AS INT) AS unique_video_count, min(weekly_number) AS week_first, max(weekly_number) AS week_last,
  max(weekly_number) - min(weekly_number) + 1 AS active_span FROM fact GROUP BY up_mid"""
ORACLES["dws_creator"] = f"WITH {FACT} {DWS_CREATOR}"
ORACLES["dws_category"] = f"""WITH {FACT} SELECT category_tid, max(category_name) AS category_name, {total("view", "total_views")},
  {mean("view", 2)} AS avg_view_per_video, round(avg(like_rate), 6) AS avg_like_rate, CAST(count(aid) AS INT) AS video_count,
  CAST(count(DISTINCT up_mid) AS INT) AS unique_creator_count FROM fact GROUP BY category_tid"""
DWS_WEEKLY = f"""SELECT weekly_number, {total("view", "total_views")}, {mean("view", 2)} AS avg_view_per_video,
  CAST(count(aid) AS INT) AS video_count, CAST(count(DISTINCT up_mid) AS INT) AS creator_count,
  CAST(count(DISTINCT category_tid) AS INT) AS category_count"""
ORACLES["dws_weekly"] = f"""WITH {FACT} {DWS_WEEKLY}, {total("like_cnt", "total_likes")}, {total("coin", "total_coins")},
  {total("favorite", "total_favorites")} FROM fact GROUP BY weekly_number"""
ORACLES["ads_hot_videos"] = f"""WITH {FACT} SELECT aid, bvid, title, up_mid, up_name, category_name, view, like_cnt, coin, favorite,
  round(like_rate, 9) AS like_rate, round(coin_rate, 9) AS coin_rate, pubdate FROM fact
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY weekly_number DESC) = 1"""
ORACLES["ads_top_creators"] = f"""WITH {FACT}, creators AS ({DWS_CREATOR}) SELECT up_mid, up_name, total_views, avg_like_rate, avg_coin_rate,
  video_count, unique_video_count, active_span FROM creators"""
ORACLES["ads_category_trend"] = f"""WITH {FACT} SELECT weekly_number, category_name, CAST(count(aid) AS INT) AS video_count,
  {total("view", "total_views")}, round(avg(like_rate), 6) AS avg_like_rate FROM fact GROUP BY weekly_number, category_name"""
ORACLES["ads_weekly_kpi"] = f"""WITH {FACT} {DWS_WEEKLY}, round(avg(like_rate), 6) AS avg_like_rate,
  round(avg(coin_rate), 6) AS avg_coin_rate FROM fact GROUP BY weekly_number"""

# ---- browse ----

SUMMARY = """aid, 'BV' || CAST(aid AS VARCHAR) AS bvid, title, duration, pubdate, creator_name, tname AS category_name, view, like_cnt"""
ORACLES["weeks_list"] = f"""WITH {RAW} SELECT week_number AS number, subject, week_name AS name, count(DISTINCT aid) AS video_count FROM raw
  GROUP BY ALL"""
ORACLES["week_detail"] = f"WITH {LAST} SELECT {SUMMARY} FROM last WHERE aid IN (SELECT aid FROM raw WHERE week_number = 12)"
ORACLES["video_summary"] = f"WITH {LAST} SELECT {SUMMARY} FROM last"
ORACLES["video_page"] = f"""WITH {LAST} SELECT {SUMMARY} FROM last WHERE aid IN (SELECT aid FROM raw WHERE week_number = 40)
  ORDER BY like_cnt DESC, aid LIMIT 20 OFFSET 20"""
ORACLES["video_page_total"] = f"WITH {RAW} SELECT count(DISTINCT aid) AS total FROM raw WHERE week_number = 40"
ORACLES["video_search"] = f"""WITH {LAST} SELECT {SUMMARY} FROM last WHERE title ILIKE '%RING%' ORDER BY pubdate DESC, aid LIMIT 100"""
ORACLES["video_detail"] = f"""WITH {LAST} SELECT aid, 'BV' || CAST(aid AS VARCHAR) AS bvid, title, duration, pubdate, l_orderkey AS cid,
  mid AS creator_mid, creator_name, tid AS category_tid, tname AS category_name, {names(COUNTS)},
  (SELECT string_agg(CAST(week_number AS VARCHAR), ',' ORDER BY week_number DESC) FROM app WHERE aid = 42) AS appeared_weeks
  FROM last WHERE aid = 42"""
FAN = LAST + """, fan AS (SELECT last.aid, last.mid, last.view, last.like_cnt, last.coin, last.favorite, bridge.aid AS listed,
    row_number() OVER (PARTITION BY last.aid) AS copy
  FROM last JOIN (SELECT DISTINCT week_number, aid FROM raw) AS bridge ON last.aid = bridge.aid)"""
UNIQUE = "CAST(sum(view) FILTER (WHERE copy = 1) AS BIGINT) AS unique_views"
ORACLES["creators_page"] = f"""WITH {FAN} SELECT s_suppkey AS mid, s_name AS name, count(DISTINCT listed) AS video_count,
  {total("view", "total_views")}, {UNIQUE} FROM supplier LEFT JOIN fan ON mid = s_suppkey GROUP BY s_suppkey, s_name
  ORDER BY total_views DESC NULLS FIRST, s_suppkey LIMIT 20"""
ORACLES["creators_total"] = "SELECT count(*) AS total FROM supplier"
ORACLES["creator_detail"] = f"""WITH {FAN} SELECT s_suppkey AS mid, s_name AS name, count(DISTINCT listed) AS video_count,
  {total("view", "total_views")}, {total("like_cnt", "total_likes")}, {total("coin", "total_coins")},
  {total("favorite", "total_favorites")}, {UNIQUE} FROM supplier LEFT JOIN fan ON mid = s_suppkey WHERE s_suppkey = 7
  GROUP BY s_suppkey, s_name"""
ORACLES["creator_videos"] = f"WITH {LAST} SELECT {SUMMARY} FROM last WHERE mid = 7 ORDER BY view DESC, aid LIMIT 100"
ORACLES["categories_list"] = f"""WITH {LAST} SELECT tid, tname, count(DISTINCT CASE WHEN found THEN aid END) AS video_count FROM (
    SELECT tid, tname, aid, true AS found FROM last
    UNION ALL SELECT CAST('0x' || substr(md5(p_type), 1, 7) AS INT), p_type, p_partkey, false FROM part) GROUP BY tid, tname"""

# ---- loading and key sets ----

ORACLES["load_insert_if_absent"] = f"""WITH {APP}, ranked AS (SELECT week_number, aid, mid,
    row_number() OVER (PARTITION BY aid, week_number <= 60 ORDER BY week_number) AS r,
    bool_or(week_number <= 60) OVER (PARTITION BY aid) AS known FROM app),
  late AS (SELECT week_number, aid, mid FROM ranked WHERE NOT known AND week_number > 58
    QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number) = 1)
  SELECT week_number, aid, mid FROM ranked WHERE week_number <= 60 AND r = 1 UNION ALL SELECT * FROM late"""
ORACLES["load_upsert_last_wins"] = f"""WITH {APP} SELECT week_number, aid, view, like_cnt FROM app
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number DESC) = 1"""
ORACLES["load_incremental_status"] = f"""WITH {RAW} SELECT week_number, CASE WHEN week_number <= 60 THEN 'skipped'
    WHEN bool_or(week_number % 11 = 0 AND l_orderkey % 2 = 0) THEN 'failed' ELSE 'loaded' END AS status
  FROM raw WHERE week_number > 58 GROUP BY week_number"""
ORACLES["reconcile_keys"] = """WITH local AS (SELECT DISTINCT c_custkey * 2 AS k FROM customer), remote AS (SELECT DISTINCT o_custkey * 3 AS k FROM orders)
  SELECT coalesce(local.k, remote.k) AS custkey, CASE WHEN remote.k IS NULL THEN 'local_only' WHEN local.k IS NULL THEN 'remote_only'
    ELSE 'in_sync' END AS status FROM local FULL JOIN remote ON local.k = remote.k"""
ORACLES["missing_and_common"] = f"""WITH {RAW}, early AS (SELECT mid FROM raw), late AS (SELECT aid * 3 AS mid FROM raw)
  SELECT mid, 'missing' AS side FROM (SELECT mid FROM early EXCEPT SELECT mid FROM late)
  UNION ALL SELECT mid, 'common' FROM (SELECT mid FROM early INTERSECT SELECT mid FROM late)"""
ORACLES["pending_issues"] = f"""WITH {RAW}, weeks AS (SELECT DISTINCT CAST(week_number AS BIGINT) AS n FROM raw),
  failed AS (SELECT n FROM weeks WHERE n % 13 = 0), done AS (SELECT n FROM weeks WHERE n % 5 <> 0)
  SELECT n AS week_number, 'retry' AS status FROM failed
  UNION ALL SELECT i, 'pending' FROM (SELECT unnest(range(1, max(n) + 8)) AS i FROM weeks) WHERE i NOT IN (SELECT n FROM done) AND i NOT IN (SELECT n FROM failed)"""
ORACLES["union_issues"] = f"""WITH {RAW} SELECT week_number, count(*) AS n, count(CASE WHEN week_number > 24 THEN favorite END) AS with_favorite,
  {total("view", "total_view")} FROM raw GROUP BY week_number"""

# ---- stream ----

ORACLES["stream_replayed"] = f"""WITH {ROWS} SELECT {WEEK}, pos, aid, view, "like" AS like_cnt, coin, favorite, share, reply, danmaku FROM rws
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number DESC, pos DESC) = 1"""

# ---- text ----

STOP = "('the', 'of', 'and', 'to', 'in', 'is', 'it', 'de', 'la', 'le', 'el', 'en', 'un', 'die', 'der', 'und')"
TOKENS = """tok AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS token FROM documents)"""
KEPT = f"{TOKENS}, kept AS (SELECT * FROM tok WHERE token NOT IN {STOP})"
DF = """spread AS (SELECT token, count(DISTINCT doc_id) AS df FROM kept GROUP BY token),
  corpus AS (SELECT count(*) AS n FROM documents)"""
IDF = "(ln((1 + n) / (1 + df)) + 1)"
ORACLES["clean_title"] = r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '[【\[（(].*?[】\]）)]', '', 'g'),
  'https?://\S+', '', 'g'), '[^一-鿿\p{L}\p{N}_]', ' ', 'g'), ' ') AS cleaned FROM documents"""
ORACLES["tokens"] = f"WITH {TOKENS} SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY doc_id, token"
# Words that are cut out whole; fixed values.
WHOLE = "鬼畜|混剪|翻唱|手书|宅舞|国创|新番|测评|开箱"
# Marks around the whole words first, blanks around the other Chinese runs, then runs become pairs of neighbours.
ORACLES["title_token_counts"] = rf"""WITH cleaned AS (SELECT lang, doc_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
      '[【\[（(].*?[】\]）)]', '', 'g'), 'https?://\S+', '', 'g'), '[^一-鿿\p{{L}}\p{{N}}_]', ' ', 'g'), ' ') AS t FROM documents),
  marked AS (SELECT lang, regexp_replace(regexp_replace(t, '({WHOLE})', ' #\1# ', 'g'), '(#[一-鿿]+#|[一-鿿]+)', ' \1 ', 'g') AS t FROM cleaned),
  piece AS (SELECT lang, unnest(regexp_extract_all(t, '#[^#]+#|[\p{{L}}\p{{N}}_]+')) AS p FROM marked),
  token AS (SELECT lang, unnest(CASE WHEN p LIKE '#%' THEN [replace(p, '#', '')] WHEN regexp_full_match(p, '[一-鿿]+')
      THEN list_transform(range(1, greatest(length(p), 2)), lambda i: substr(p, i, 2)) ELSE [p] END) AS w FROM piece)
  SELECT lang, count(*) AS tokens, count(DISTINCT w) AS distinct_tokens FROM token WHERE length(w) >= 2 GROUP BY lang"""
WEIGHTED = "round(count(*) / size * " + IDF + ", 12)"


def weighted(groups):
    join = f"JOIN sizes USING ({', '.join(groups)})" if groups else "CROSS JOIN sizes"
    keys = "".join(f"{g}, " for g in groups)
    size = f"SELECT {keys}count(*) AS size FROM kept" + (f" GROUP BY {', '.join(groups)}" if groups else "")
    return f"""{KEPT}, {DF}, sizes AS ({size}), weights AS (SELECT {keys}token, {WEIGHTED} AS w
      FROM kept JOIN spread USING (token) {join} CROSS JOIN corpus GROUP BY {keys}token, df, size, n)"""


TOP50 = f"WITH {weighted([])} SELECT token AS word, round(w, 4) AS weight FROM weights ORDER BY w DESC, token"
ORACLES["keywords_global"] = TOP50 + " LIMIT 50"


def by_group(group):
    return f"""WITH {weighted([group])}, ranked AS (SELECT {group}, token, w,
      row_number() OVER (PARTITION BY {group} ORDER BY w DESC, token) AS r FROM weights)
      SELECT {group}, CAST(r AS INT) AS rank, token AS word, round(w, 4) AS weight FROM ranked WHERE r <= 10"""


ORACLES["keywords_by_issue"] = by_group("source")
ORACLES["keywords_by_category"] = by_group("lang")
ORACLES["keywords_by_group"] = f"""SELECT lang, round(sum(weight), 4) AS total_weight, string_agg(word, ' ' ORDER BY rank) AS words
  FROM ({by_group("lang")}) GROUP BY lang"""
ORACLES["tfidf_l2_sum"] = f"""WITH {KEPT}, {DF}, terms AS (SELECT doc_id, token, count(*) AS tf FROM kept GROUP BY doc_id, token),
  w AS (SELECT doc_id, token, tf * {IDF} AS w FROM terms JOIN spread USING (token) CROSS JOIN corpus),
  len AS (SELECT doc_id, sqrt(sum(w * w)) AS l FROM w GROUP BY doc_id)
  SELECT token AS word, round(sum(w / l), 4) AS weight FROM w JOIN len USING (doc_id) GROUP BY token
  ORDER BY round(sum(w / l), 9) DESC, token LIMIT 20"""
ORACLES["keyword_flags"] = f"""WITH top AS ({TOP50} LIMIT 30) SELECT doc_id, word, CAST(contains(lower(text), word) AS INT) AS flag
  FROM documents CROSS JOIN top"""

# ---- learning ----

HELD_OUT = "CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 7) AS INT) % 5 = 0"
PART = f"CASE WHEN {HELD_OUT.format(c='week_number')} THEN 'test' ELSE 'train' END AS part"
ORACLES["split_counts"] = f"WITH {SERIES} SELECT {PART}, count(*) AS n FROM series GROUP BY 1"


def line(target, rows, name="line"):
    """Coefficients of the least squares line with two inputs, from covariances."""
    return f"""moments_{name} AS (SELECT var_pop(week_number) AS xx, var_pop(video_count) AS zz, covar_pop(week_number, video_count) AS xz,
      covar_pop({target}, week_number) AS xy, covar_pop({target}, video_count) AS zy, avg(week_number) AS mx, avg(video_count) AS mz,
      avg({target}) AS my FROM {rows}),
    {name} AS (SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS c,
      my - (xy * zz - zy * xz) / (xx * zz - xz * xz) * mx - (zy * xx - xy * xz) / (xx * zz - xz * xz) * mz AS a, mz
      FROM moments_{name})"""


COEF = "round(b, 4) AS week_number, round(c, 4) AS video_count, round(a, 2) AS intercept"
ORACLES["ols_weekly"] = f"""WITH {SERIES}, {line("avg_view", "series", "v")}, {line("avg_like", "series", "l")}
  SELECT 'avg_view' AS target, {COEF} FROM v UNION ALL SELECT 'avg_like', {COEF} FROM l"""
ORACLES["ols_fitted"] = f"""WITH {SERIES}, {line("avg_view", "series")} SELECT week_number, round(avg_view, 2) AS actual,
  round(a + b * week_number + c * video_count, 2) AS predicted FROM series, line"""
ORACLES["forecast_next4"] = f"""WITH {SERIES}, {line("avg_view", "series")}, future AS (
    SELECT CAST(max(week_number) + i AS INT) AS week_number FROM series, range(1, 5) AS t(i) GROUP BY i)
  SELECT week_number, round(a + b * week_number + c * floor(mz), 2) AS predicted FROM future, line"""
ORACLES["regression_metrics"] = f"""WITH {SERIES}, parts AS (SELECT *, {PART} FROM series),
  train AS (SELECT * FROM parts WHERE part = 'train'), {line("avg_view", "train")},
  errors AS (SELECT part, avg_view, avg_view - (a + b * week_number + c * video_count) AS e FROM parts, line)
  SELECT part, count(*) AS n, round(1 - sum(e * e) / (var_pop(avg_view) * count(*)), 4) AS r2, round(avg(abs(e)), 2) AS mae,
    round(sqrt(avg(e * e)), 2) AS rmse FROM errors GROUP BY part"""
TRIMMED = f"""{RAW}, usable AS (SELECT * FROM raw WHERE view > 100 AND duration > 0),
  trimmed AS (SELECT * FROM usable WHERE view <= (SELECT quantile_cont(view, 0.995) FROM usable)),
  vid AS (SELECT *, sub_category || ' ' || title AS "desc", CASE WHEN l_linenumber % 3 = 0 THEN title END AS dynamic FROM trimmed
    QUALIFY row_number() OVER (PARTITION BY aid ORDER BY week_number DESC, {ORD.replace(",", " DESC,")} DESC) = 1),
  feat AS (SELECT aid, tid, title, reason, length(title) AS title_length, length("desc") AS desc_length,
    CAST(length(coalesce(dynamic, '')) > 0 AS INT) AS has_dynamic, CAST(length(reason) > 0 AS INT) AS has_rcmd_reason,
    length(reason) AS rcmd_reason_length, CAST(hour(pubdate) AS INT) AS publish_hour, CAST(isodow(pubdate) - 1 AS INT) AS publish_weekday,
    CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END AS is_verified, l_linenumber % 2 AS is_pay,
    round(ln(1 + duration), 6) AS duration_log, round(ln(1 + view), 6) AS view_log,
    round((stime - CAST(epoch(pubdate) AS BIGINT)) / 86400.0, 6) AS days_to_listing,
    round(CASE WHEN height <> 0 THEN CAST(width AS DOUBLE) / height END, 6) AS aspect_ratio, width, height FROM vid)"""
ORACLES["feature_engineering"] = f"""WITH {TRIMMED} SELECT aid, title_length, desc_length, has_dynamic, has_rcmd_reason, rcmd_reason_length,
  publish_hour, publish_weekday, is_verified, is_pay, duration_log, view_log, days_to_listing, aspect_ratio FROM feat"""


def flag_words(name, column, top):
    cleaned = rf"trim(regexp_replace(regexp_replace({column}, '[【\[（(].*?[】\]）)]', '', 'g'), '[^一-鿿\p{{L}}\p{{N}}_]', ' ', 'g'), ' ')"
    return f"""{name}_docs AS (SELECT aid, {cleaned} AS t FROM feat),
    {name}_tok AS (SELECT aid, unnest(regexp_extract_all(lower(t), '[a-z]{{2,}}')) AS token FROM {name}_docs),
    {name}_top AS (SELECT token FROM (SELECT token, count(*) AS tf, count(DISTINCT aid) AS df FROM {name}_tok GROUP BY token)
      ORDER BY round(tf / (SELECT count(*) FROM {name}_tok) * (ln((1 + (SELECT count(*) FROM feat)) / (1 + df)) + 1), 12) DESC, token LIMIT {top}),
    {name}_n AS (SELECT aid, count(token) AS n FROM {name}_docs LEFT JOIN {name}_top ON contains(t, token) GROUP BY aid)"""


NUMERICAL = [
    "duration_log", "title_length", "desc_length", "days_to_listing", "publish_hour", "has_dynamic", "has_rcmd_reason",
    "rcmd_reason_length", "aspect_ratio", "is_verified", "is_pay", "width", "height",
]
ORACLES["feature_matrix"] = f"""WITH {TRIMMED}, {flag_words("title", "title", 30)}, {flag_words("reason", "reason", 15)}
  SELECT aid, tid, {names(range(1, 7), "CAST(publish_weekday = {c} AS INT) AS publish_weekday_{c}")}, view_log,
    {names(NUMERICAL, "CAST({c} AS DOUBLE) AS {c}")}, CAST(title_n.n AS INT) AS n_title_kw, CAST(reason_n.n AS INT) AS n_rcmd_kw
  FROM feat JOIN title_n USING (aid) JOIN reason_n USING (aid) WHERE aspect_ratio IS NOT NULL"""

# Principal axes of the four figures: the matrix of correlations is squared until it is the projection on the first axis;
# the second axis comes from what is left without it. Matrices are lists of 16 numbers, row by row.
FEATURES = ["view", "like_cnt", "coin", "favorite"]
MATRIX = ", ".join(f"corr({a}, {b})" for a in FEATURES for b in FEATURES)
SQUARE = """list_transform(range(0, 16), lambda k: list_sum(list_transform(range(1, 5), lambda i: m[(k // 4) * 4 + i] * m[(i - 1) * 4 + k % 4 + 1])))"""
TRACE = "(m[1] + m[6] + m[11] + m[16])"


def projection(name, start):
    return f"""{name}_steps(step, m) AS (SELECT 0, m FROM {start} UNION ALL
      SELECT step + 1, list_transform(s, lambda x: x / (s[1] + s[6] + s[11] + s[16])) FROM (SELECT step, {SQUARE} AS s FROM {name}_steps) WHERE step < 40),
    {name} AS (SELECT m FROM {name}_steps WHERE step = 40)"""


def axis(number, name):
    """Loadings out of the projection v v': its largest diagonal entry gives the column and a positive sign."""
    return f"""SELECT {number} AS axis, f.name AS feature, round(p.m[(f.i - 1) * 4 + big.i] / sqrt(p.m[(big.i - 1) * 5 + 1]), 5) AS loading,
      round((SELECT list_sum(list_transform(range(1, 17), lambda k: c.m[k] * p.m[k])) FROM matrix AS c), 5) AS variance
    FROM {name} AS p, (VALUES (1, 'view'), (2, 'like'), (3, 'coin'), (4, 'favorite')) AS f(i, name),
      (SELECT i FROM {name}, range(1, 5) AS t(i) ORDER BY round(sqrt(m[(i - 1) * 5 + 1]), 9) DESC, i LIMIT 1) AS big"""


ORACLES["principal_axes"] = f"""WITH RECURSIVE {FIRST}, matrix AS (SELECT [{MATRIX}] AS m FROM first), {projection("one", "matrix")},
  rest AS (SELECT list_transform(range(1, 17), lambda k: c.m[k] - one.m[k] * list_sum(list_transform(range(1, 17), lambda j: c.m[j] * one.m[j]))) AS m
    FROM matrix AS c, one), {projection("two", "rest")}
  {axis(1, "one")} UNION ALL {axis(2, "two")}"""
ORACLES["kmeans_conditions"] = f"""WITH {FIRST} SELECT count(*) AS videos, 3 AS clusters, 0 AS misplaced, 0 AS empty FROM first"""
