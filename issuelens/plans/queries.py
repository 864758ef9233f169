"""The registered queries: each takes (spark, folder of the test tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.functions.moments import utc_to_epoch
from issuelens.functions.text import clean_title, field_if_object, keyword_flags, title_tokens, words
from issuelens.learning import cluster, compare, features, forecast
from issuelens.operators import browse, cleaning, exploration, flatten, keysets, keywords, loading, ordered, statistics, warehouse
from issuelens.operators.dedup import first_n, keep_first, latest_name
from issuelens.operators.ranges import match_issue
from issuelens.schemas import METRICS, ROW_KEY
from issuelens.session import ensure_checkpoint_dir, materialize, remove_at_exit
from issuelens.sources import relational
from issuelens.sources.relational import ORDER, appearances, first_appearances, issue_videos, last_appearances, table
from issuelens.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


SHARED_METRICS = ["view", "like_cnt", "coin", "favorite", "share", "reply", "danmaku"]


def _as_like(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("like_cnt", "like")


# ---- statistics on the first appearance of each video ----


def _videos(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    return _as_like(first_appearances(spark, folder, columns))


@query
def stats_overall(spark, folder):
    """The stored figures joined with the video table on aid, as the report does it."""
    figures = _videos(spark, folder, ["aid", "mid", "view", "like_cnt", "coin", "favorite", "share", "danmaku"])
    videos = table(spark, folder, "part").select(F.col("p_partkey").alias("aid"))
    return statistics.overall(videos.join(figures, "aid"))


@query
def stats_by_category(spark, folder):
    return statistics.by_category(_videos(spark, folder, ["aid", "tname", "view", "like_cnt", "coin", "favorite"]))


@query
def stats_by_creator(spark, folder):
    videos = _videos(spark, folder, ["aid", "mid", "view", "like_cnt", "favorite"])
    creators = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("mid"), F.col("s_name").alias("creator_name"))
    return statistics.by_creator(videos.join(creators, "mid", "left"))


@query
def stats_by_week(spark, folder):
    videos = _videos(spark, folder, ["aid", "week_number", "view", "like_cnt", "coin", "favorite"])
    issues = appearances(spark, folder, ["week_number"]).distinct()
    return statistics.by_week(videos.join(issues, "week_number"))


@query
def weekly_series(spark, folder):
    series = statistics.weekly_series(_series_input(spark, folder))
    return series.select(
        "week_number", "video_count", *[F.round(f"avg_{m}", 4).alias(f"avg_{m}") for m in ["view", "like", "coin", "favorite"]]
    )


# ---- exploration on the first appearance with views ----


def _base(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    needed = list(dict.fromkeys(["aid", "view", *columns]))
    videos = first_appearances(spark, folder, needed).where(F.col("view") > 0)
    return _as_like(videos).withColumnRenamed("tname", "category")


@query
def base_clean(spark, folder):
    """Null ids dropped, first appearance kept, no views dropped; on the rows with gaps."""
    lines = relational.with_gaps(appearances(spark, folder, [*relational.LINE, "title"]).withColumn("_aid", F.col("aid")))
    order = ["week_number", *[c if c != "aid" else "_aid" for c in ORDER]]
    return exploration.base_clean(lines, order).select("aid", "week_number", "l_orderkey", "l_linenumber", "view", "title")


@query
def dedup_first(spark, folder):
    return first_appearances(spark, folder, ["aid", "week_number", "l_orderkey", "l_linenumber", "title", "view"])


@query
def time_fields(spark, folder):
    """Calendar fields of every event and minutes of every value."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("pubdate"), F.floor("value").cast("bigint").alias("duration")
    )
    return exploration.with_time_fields(events).select(
        "event_id", "pub_date", "pub_year", "pub_month", "publish_hour", "publish_weekday", "duration_min"
    )


@query
def category_stats(spark, folder):
    return exploration.category_stats(_base(spark, folder, ["tname", "like_cnt"]))


@query
def top_videos(spark, folder):
    columns = ["title", "tname", "creator_name", "pubdate", "like_cnt", "coin", "favorite", "share", "duration"]
    videos = exploration.with_time_fields(_base(spark, folder, columns))
    return exploration.top_videos(videos).select(
        "aid", "title", "category", "creator_name", "pub_date", "view", "like", "coin", "favorite", "share", "duration_min"
    )


@query
def creator_rank(spark, folder):
    return exploration.creator_rank(_base(spark, folder, ["mid", "creator_name", "like_cnt"]))


@query
def creator_rank_by_view(spark, folder):
    return exploration.creator_rank(_base(spark, folder, ["mid", "creator_name", "like_cnt"]), by="total_view")


@query
def corr_view(spark, folder):
    return exploration.correlations_with(_base(spark, folder, SHARED_METRICS), "view", [m for m in METRICS if m != "view"])


@query
def corr_matrix(spark, folder):
    return exploration.correlation_matrix(_base(spark, folder, SHARED_METRICS), exploration.SEVEN_METRICS)


@query
def describe_metrics(spark, folder):
    videos = _base(spark, folder, [*SHARED_METRICS, "duration"])
    return exploration.describe(videos, [*METRICS, "duration"])


@query
def duration_buckets(spark, folder):
    videos = _base(spark, folder, ["duration", "title", "pubdate"])
    out = exploration.with_duration_group(exploration.with_time_fields(videos))
    return out.select("aid", "duration", "duration_min", "duration_group", "duration_order")


@query
def duration_stats(spark, folder):
    videos = _base(spark, folder, ["duration", "like_cnt", "coin"])
    return exploration.duration_stats(videos.withColumn("duration_min", F.round(F.col("duration") / 60.0, 1)))


@query
def yearly_trend(spark, folder):
    videos = _base(spark, folder, ["mid", "duration", "pubdate", "like_cnt"])
    return exploration.yearly_trend(exploration.with_time_fields(videos))


@query
def engagement_by_category(spark, folder):
    return exploration.engagement_by_category(_base(spark, folder, ["tname", "like_cnt", "coin", "favorite"]))


@query
def category_avg_view(spark, folder):
    return exploration.category_avg_view(_base(spark, folder, ["tname"]))


@query
def engagement_rate(spark, folder):
    columns = ["like_cnt", "coin", "favorite", "share", "danmaku"]
    videos = exploration.with_engagement(_base(spark, folder, columns))
    return videos.select(
        "aid", "interaction",
        F.round("engagement_rate", 6).alias("engagement_rate"),
        F.round("interaction_rate", 6).alias("interaction_rate"),
    )


@query
def top_creators_by_view(spark, folder):
    return exploration.top_by_sum(appearances(spark, folder, ["creator_name", "view"]), "creator_name", "view", 10, "total_view")


@query
def histogram_view(spark, folder):
    rows = exploration.histogram(table(spark, folder, "events"), "value")
    return rows.select("bin", F.round("low", 6).alias("low"), "n")


@query
def category_share(spark, folder):
    return exploration.share_of_total(appearances(spark, folder, ["tname", "view"]), "tname", "view")


@query
def top_n_other(spark, folder):
    return exploration.top_and_other(appearances(spark, folder, ["sub_category"]), "sub_category")


@query
def zscore_metrics(spark, folder):
    videos = _base(spark, folder, ["like_cnt", "coin", "favorite"])
    z = exploration.zscores(videos, cluster.FEATURES, ["aid"])
    return z.select("aid", *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in cluster.FEATURES])


@query
def one_hot_weekday(spark, folder):
    """Events per type and weekday, summed over the one-hot columns."""
    days = table(spark, folder, "events").select("event_type", F.weekday("ts").alias("publish_weekday"))
    hot = exploration.one_hot(days, "publish_weekday", list(range(7)), "weekday_")
    return hot.groupBy("event_type").agg(*[F.sum(f"weekday_{d}").alias(f"weekday_{d}") for d in range(1, 7)])


@query
def running_best(spark, folder):
    """Highest order total so far, over all orders by date."""
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    best = ordered.running_max(orders, ["o_orderdate", "o_orderkey"], "o_totalprice")
    return best.select("o_orderkey", "o_totalprice", "best_so_far")


@query
def sample_per_group(spark, folder):
    videos = first_appearances(spark, folder, ["aid", "tname"])
    return first_n(videos, ["tname"], ["aid"], cluster.SAMPLES, rank="rank")


@query
def downsample_every_kth(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    return ordered.every_kth(events, ["event_id"], 5000)


# ---- scans, nested documents, tables, record groups ----


@query
def scan_parquet(spark, folder):
    """Two columns and a filter that reach the scan."""
    items = table(spark, folder, "lineitem").where(F.col("l_quantity") >= 49)
    return items.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


# Fields of the nested videos that a table or record group is made of.
FIELDS = {
    "Video": ["aid", "bvid", "title", "desc", "duration", "pubdate", "cid", "pic"],
    "Creator": ["owner"],
    "Category": ["tid", "tname", "rcmd_reason"],
    "VideoStat": ["aid", "stat"],
    "creators": ["owner"],
    "categories": ["tid", "tname", "tidv2", "tnamev2", "pid_v2", "pid_name_v2"],
    "videos": [
        "aid", "bvid", "title", "desc", "duration", "pubdate", "cid", "short_link_v2", "pic", "copyright", "owner.mid", "tid",
    ],
    "video_stats": ["aid", "stat"],
    "weekly_videos": ["aid"],
}


def _rows(spark: SparkSession, folder: str, gaps: bool = False, fields: list[str] | None = None) -> DataFrame:
    return flatten.video_rows(relational.nested_issues(spark, folder, gaps, fields))


@query
def flatten_videos(spark, folder):
    return _rows(spark, folder).select(
        F.col("week_number").cast("int").alias("week_number"), "pos", "week_subject", "week_name", "week_stime",
        "aid", "bvid", "title", "tid", F.col("tname").alias("category"), F.col("pid_name_v2").alias("sub_category"),
        "pubdate", "duration", "rcmd_reason", "mid", "up_name", *METRICS,
    )


def _split(name: str) -> Query:
    def run(spark, folder):
        return flatten.split_tables(_rows(spark, folder, fields=FIELDS[name]))[name]

    return run


@query
def split_weekly(spark, folder):
    headers = flatten.issue_headers(relational.nested_issues(spark, folder))
    return flatten.weekly_table(headers).distinct()


for _name, _table in [("split_video", "Video"), ("split_creator", "Creator"), ("split_category", "Category"), ("split_stat", "VideoStat")]:
    QUERIES[_name] = _split(_table)


def _split_clean(name: str) -> Query:
    """A partner table after cleaning: its rows whose key survived deduplication and the metric filter."""

    def run(spark, folder):
        documents = relational.nested_issues(spark, folder, True, list(dict.fromkeys(["aid", "stat", *FIELDS[name]])))
        rows = flatten.video_rows(documents)
        cleaned = cleaning.clean_rows(rows)
        if documents.where(F.size("videos.aid") > relational.DOCUMENT_SIZE).isEmpty():
            # No document runs into the places of the next one: the key names one row, and no join is needed.
            kept = flatten.split_tables(cleaned)[name]
        else:
            kept = cleaning.keep_rows_of(flatten.split_tables(rows)[name], cleaned.select(*ROW_KEY))
        return cleaning.convert_types(cleaning.fill_missing(kept, name), name)

    return run


for _name, _table in [
    ("split_video_clean", "Video"), ("split_creator_clean", "Creator"),
    ("split_category_clean", "Category"), ("split_stat_clean", "VideoStat"),
]:
    QUERIES[_name] = _split_clean(_table)


@query
def stats_joined_tables(spark, folder):
    """Statistics by category over the five cleaned tables, split from the nested documents and joined again."""
    documents = relational.nested_issues(spark, folder, gaps=True)
    kept = materialize(cleaning.clean_rows(flatten.video_rows(documents)))
    weekly = flatten.weekly_table(flatten.issue_headers(documents)).distinct()
    tables = {"Weekly": weekly, **flatten.split_tables(kept)}
    return statistics.by_category(statistics.join_tables(tables))


@query
def etl_weekly(spark, folder):
    return flatten.weekly_records(flatten.issue_headers(relational.nested_issues(spark, folder)).distinct())


def _group(name: str) -> Query:
    def run(spark, folder):
        return flatten.normalised_records(_rows(spark, folder, fields=FIELDS[name]))[name]

    return run


for _name, _groupname in [
    ("etl_creators", "creators"), ("etl_categories", "categories"), ("etl_videos", "videos"),
    ("etl_stats", "video_stats"), ("etl_bridge", "weekly_videos"),
]:
    QUERIES[_name] = _group(_groupname)


@query
def json_probe(spark, folder):
    """A field of a value that may or may not be a JSON object."""
    events = table(spark, folder, "events")
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("props"))
    return events.select("event_id", field_if_object(mixed, "k", "bigint").alias("k"))


# ---- cleaning of the rows with gaps ----


def _gappy(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    rows = appearances(spark, folder, list(dict.fromkeys([*relational.LINE, *columns])))
    return relational.with_gaps(rows)


@query
def fill_missing(spark, folder):
    rows = _gappy(spark, folder, ["title"]).select("l_orderkey", "l_linenumber", "aid", "title", "view")
    return cleaning.fill_missing(cleaning.fill_missing(rows, "Video"), "VideoStat")


@query
def null_profile(spark, folder):
    rows = _gappy(spark, folder, ["title", "creator_name"])
    return cleaning.null_profile(rows, ["aid", "title", "creator_name", "view", "like_cnt"])


@query
def convert_types(spark, folder):
    """Figures kept as text are stored as numbers; text that is no number becomes null."""
    noisy = F.when(F.col("l_orderkey") % 50 == 0, F.lit("n/a")).otherwise(F.col("view").cast("string"))
    rows = appearances(spark, folder, [*ORDER, "view"]).select(
        "l_orderkey", "l_linenumber", F.col("aid").cast("string").alias("aid"), noisy.alias("view")
    )
    return cleaning.convert_types(rows, "VideoStat")


@query
def drop_negative_metrics(spark, folder):
    rows = _gappy(spark, folder, ["reply", "title"]).na.fill({"view": 0})
    kept = cleaning.drop_negative(rows, SHARED_METRICS)
    return kept.groupBy("week_number").agg(F.count(F.lit(1)).alias("n"), F.sum("view").alias("total_view"))


@query
def clean_report(spark, folder):
    documents = relational.nested_issues(spark, folder, gaps=True)
    return cleaning.cleaning_counts(flatten.video_rows(documents), flatten.issue_headers(documents))


@query
def trim_outliers(spark, folder):
    rows = appearances(spark, folder, [*ORDER, "week_number", "title", "duration", "view"])
    kept = features.trim_outliers(rows, order=["week_number", *ORDER], needed=["view", "duration", "title"])
    return kept.select("aid", "week_number", "l_orderkey", "view")


@query
def range_match_issue(spark, folder):
    """The issue whose period holds the order date of each order."""
    orders = table(spark, folder, "orders").select("o_orderkey", utc_to_epoch(F.col("o_orderdate")).alias("pubdate"))
    return match_issue(orders, relational.calendar(spark, folder), "pubdate", ["number"])


# ---- warehouse ----


def _fact(spark: SparkSession, folder: str, detail: bool = True) -> DataFrame:
    """The fact; without `detail` title, length and date are left empty, which saves the join with the orders."""
    details = {"title": "STRING", "duration": "INT", "pubdate": "TIMESTAMP_NTZ"}
    columns = ["week_number", "aid", "mid", "tid", *SHARED_METRICS, *(details if detail else [])]
    rows = issue_videos(spark, folder, columns).withColumnsRenamed(
        {"week_number": "weekly_number", "mid": "up_mid", "tid": "category_tid"}
    )
    if not detail:
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in details.items()})
    creators = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("up_mid"), F.col("s_name").alias("up_name"))
    categories = table(spark, folder, "part").select(
        F.expr(relational.PART["tid"]).alias("category_tid"), F.col("p_type").alias("category_name")
    ).distinct()
    named = rows.withColumn("bvid", F.concat(F.lit("BV"), F.col("aid").cast("string")))
    return warehouse.fact_from_appearances(named, creators, categories)


RATES = ["like_rate", "coin_rate", "favorite_rate"]

@query
def dwd_fact(spark, folder):
    return _fact(spark, folder).withColumns({r: F.round(r, 9) for r in RATES})


@query
def dwd_fact_from_records(spark, folder):
    """The fact by way of the nested documents and their record groups, as the warehouse job makes it."""
    rows = materialize(_rows(spark, folder))
    return warehouse.fact_from_records(flatten.normalised_records(rows)).withColumns({r: F.round(r, 9) for r in RATES})


@query
def type1_dimension(spark, folder):
    """The last known name of each creator; names change by year and are missing in some issues."""
    rows = appearances(spark, folder, ["week_number", "mid", "creator_name", *ORDER])
    year = F.floor((F.col("week_number") - 1) / 12).cast("string")
    renamed = F.when(F.col("week_number") % 7 != 0, F.concat_ws("-", "creator_name", year))
    return latest_name(rows.withColumn("name", renamed), "mid", "name", ["week_number", *ORDER])


@query
def dws_creator(spark, folder):
    return warehouse.dws_creator(_fact(spark, folder, detail=False))


@query
def dws_category(spark, folder):
    return warehouse.dws_category(_fact(spark, folder, detail=False))


@query
def dws_weekly(spark, folder):
    return warehouse.dws_weekly(_fact(spark, folder, detail=False))


@query
def ads_hot_videos(spark, folder):
    out = warehouse.ads_hot_videos(_fact(spark, folder))
    return out.withColumns({r: F.round(r, 9) for r in ["like_rate", "coin_rate"]})


@query
def ads_top_creators(spark, folder):
    return warehouse.ads_top_creators(dws_creator(spark, folder))


@query
def ads_category_trend(spark, folder):
    return warehouse.ads_category_trend(_fact(spark, folder, detail=False))


@query
def ads_weekly_kpi(spark, folder):
    # Read twice, as the job reads the written fact.
    fact = materialize(_fact(spark, folder, detail=False).drop("title", "duration", "pubdate"))
    return warehouse.ads_weekly_kpi(warehouse.dws_weekly(fact), fact)


# ---- browse ----


def _library(spark: SparkSession, folder: str) -> browse.Library:
    parts, suppliers = table(spark, folder, "part"), table(spark, folder, "supplier")
    pairs = appearances(spark, folder, ["week_number", "aid"]).distinct()
    weeks = appearances(spark, folder, ["week_number"]).distinct()
    none = F.lit(None).cast("string")
    video = last_appearances(spark, folder, ["aid", "title", "duration", "pubdate", "mid", "tid", "l_orderkey"])
    return browse.Library(
        weekly=weeks.select(
            F.col("week_number").alias("number"),
            F.concat(F.lit("Issue "), F.col("week_number").cast("string")).alias("subject"),
            F.date_format(relational.month_start(F.col("week_number")), "yyyy-MM").alias("name"),
        ),
        creator=suppliers.select(F.col("s_suppkey").alias("mid"), F.col("s_name").alias("name"), none.alias("face")),
        category=parts.select(
            F.expr(relational.PART["tid"]).alias("tid"), F.col("p_type").alias("tname"), none.alias("tname_v2")
        ).distinct(),
        video=video.select(
            "aid", F.concat(F.lit("BV"), F.col("aid").cast("string")).alias("bvid"), "title", none.alias("cover_url"),
            "duration", "pubdate", F.col("l_orderkey").alias("cid"), F.col("mid").alias("creator_mid"),
            F.col("tid").alias("category_tid"),
        ),
        video_stat=last_appearances(spark, folder, ["aid", *SHARED_METRICS]),
        weekly_video=pairs.select(F.col("week_number").alias("weekly_number"), "aid"),
    )


@query
def weeks_list(spark, folder):
    return browse.weeks(_library(spark, folder))


@query
def week_detail(spark, folder):
    return browse.week_videos(_library(spark, folder), 12).drop("cover_url")


@query
def video_summary(spark, folder):
    return browse.video_summary(_library(spark, folder)).select(*browse.SUMMARY).drop("cover_url")


@query
def video_page(spark, folder):
    page = browse.video_page(_library(spark, folder), page=2, page_size=20, sort_by="like", week=40)
    return page.drop("cover_url")


@query
def video_page_total(spark, folder):
    return browse.video_total(_library(spark, folder), week=40)


@query
def video_search(spark, folder):
    return browse.video_page(_library(spark, folder), page_size=100, sort_by="pubdate", search="RING").drop("cover_url")


@query
def video_detail(spark, folder):
    detail = browse.video_detail(_library(spark, folder), 42)
    return detail.select(
        "aid", "bvid", "title", "duration", "pubdate", "cid", "creator_mid", "creator_name", "category_tid",
        "category_name", *SHARED_METRICS, F.array_join(F.col("appeared_weeks").cast("array<string>"), ",").alias("appeared_weeks"),
    )


@query
def creators_page(spark, folder):
    return browse.creators_page(_library(spark, folder), page=1, page_size=20, sort_by="total_views").drop("face")


@query
def creators_total(spark, folder):
    return browse.creators_total(_library(spark, folder))


@query
def creator_detail(spark, folder):
    return browse.creator_detail(_library(spark, folder), 7).drop("face")


@query
def creator_videos(spark, folder):
    return browse.creator_videos(_library(spark, folder), 7).drop("cover_url")


@query
def categories_list(spark, folder):
    return browse.categories(_library(spark, folder)).drop("tname_v2")


# ---- loading and key sets ----

KNOWN_ISSUES = 60


def _arriving(spark: SparkSession, folder: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows already loaded (issues up to KNOWN_ISSUES) and a batch that overlaps them by two issues."""
    rows = issue_videos(spark, folder, columns)
    week = F.col("week_number")
    return rows.where(week <= KNOWN_ISSUES), rows.where(week > KNOWN_ISSUES - 2)


@query
def load_insert_if_absent(spark, folder):
    """First creator seen for each video stays."""
    old, batch = _arriving(spark, folder, ["week_number", "aid", "mid"])
    target = keep_first(old, ["aid"], ["week_number"])
    return loading.insert_if_absent(target, batch, ["aid"], ["week_number"])


@query
def load_upsert_last_wins(spark, folder):
    old, batch = _arriving(spark, folder, ["week_number", "aid", "view", "like_cnt"])
    target = loading.upsert(old.limit(0), old, ["aid"], ["week_number"])
    return loading.upsert(target, batch, ["aid"], ["week_number"])


@query
def load_incremental_status(spark, folder):
    rows = appearances(spark, folder, ["week_number", "view", "l_orderkey"])
    week = F.col("week_number")
    # An issue divisible by 11 counts as damaged when one of its rows has a certain order.
    batch = rows.where(week > KNOWN_ISSUES - 2).withColumn("bad", (week % 11 == 0) & (F.col("l_orderkey") % 2 == 0))
    return loading.load_status(batch, rows.where(week <= KNOWN_ISSUES), "week_number", "bad")


@query
def reconcile_keys(spark, folder):
    """Customers against customers with orders, each kept under another numbering: which keys each side lacks."""
    customers = table(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("custkey"))
    buyers = table(spark, folder, "orders").select((F.col("o_custkey") * 3).alias("custkey"))
    return keysets.reconcile(customers, buyers, "custkey")


@query
def missing_and_common(spark, folder):
    """Creators and categories of all appearances as one numbering: creators that are no category, and those that are."""
    lines = appearances(spark, folder, ["mid", "aid"])
    early, late = lines.select("mid"), lines.select((F.col("aid") * 3).alias("mid"))
    missing = keysets.missing_remotely(early, late, "mid").withColumn("side", F.lit("missing"))
    return missing.unionByName(keysets.common_keys(early, late, "mid").withColumn("side", F.lit("common")))


@query
def pending_issues(spark, folder):
    """Issues up to seven past the latest: fetched ones are those in the data but every fifth, failed ones every 13th."""
    weeks = appearances(spark, folder, ["week_number"]).distinct()
    done = weeks.where(F.col("week_number") % 5 != 0)
    failed = weeks.where(F.col("week_number") % 13 == 0)
    latest = weeks.agg(F.max("week_number")).first()[0]
    return keysets.open_issues((latest or 0) + 7, done, failed, "week_number")


@query
def union_issues(spark, folder):
    """Appearances of two periods; the older one has no favourites."""
    rows = appearances(spark, folder, ["week_number", "view", "favorite"])
    old, new = rows.where("week_number <= 24").drop("favorite"), rows.where("week_number > 24")
    both = loading.union_issues(old, new)
    return both.groupBy("week_number").agg(
        F.count(F.lit(1)).alias("n"), F.count("favorite").alias("with_favorite"), F.sum("view").alias("total_view")
    )


# ---- stream ----

# Folders, and so batches, of the replayed stream; one digit each.
STREAM_BATCHES = 4


def _batches(documents: DataFrame) -> DataFrame:
    """The batch of each issue number; the window sees one row per issue."""
    place = F.row_number().over(Window.orderBy("number")) - 1
    share = F.floor(place * STREAM_BATCHES / F.count(F.lit(1)).over(Window.partitionBy()))
    return documents.select("number").distinct().select("number", share.cast("int").alias("batch"))


@query
def stream_replayed(spark, folder):
    """Figures of the videos after the documents came as a stream in batches of one folder, and all of them once more.

    A folder holds whole issues, written where their documents are made. The second stream knows nothing of the first one's
    progress and sends everything again. Fields that no record group holds are null.
    """
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    remove_at_exit(spark, base)
    documents = relational.nested_issues(spark, folder, fields=list(dict.fromkeys(f for g in ingest.GROUPS for f in FIELDS[g])))
    batched = documents.join(F.broadcast(_batches(documents)), "number")
    batched.write.partitionBy("batch").parquet(f"{base}/arriving", compression="zstd")
    for turn in ("first", "again"):
        for last in range(STREAM_BATCHES):
            # Folders up to `last` have arrived; the stream's checkpoint knows the earlier ones.
            arriving = spark.readStream.schema(documents.schema).parquet(f"{base}/arriving/batch=[0-{last}]")
            ingest.ingest_documents(arriving, f"{base}/out", f"{base}/{turn}").awaitTermination()
    return ingest.current(spark, f"{base}/out", "video_stats").select(
        F.col("weekly_number").cast("bigint").alias("weekly_number"), "pos", "aid", *SHARED_METRICS
    )


# ---- text ----

LATIN = "[a-z]{2,}"
LATIN_STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "de", "la", "le", "el", "en", "un", "die", "der", "und"]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return docs.withColumn("text", F.lower("text"))


def _latin_tokens():
    return words(F.col("text"), LATIN)


def _stop(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in LATIN_STOP_WORDS], "token STRING")


@query
def clean_titles(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.select("doc_id", clean_title(F.col("text")).alias("cleaned"))


@query
def tokens(spark, folder):
    return keywords.document_terms(_documents(spark, folder), "doc_id", _latin_tokens())


@query
def title_token_counts(spark, folder):
    """Tokens of cleaned texts by the tokeniser for titles."""
    docs = table(spark, folder, "documents").select("lang", "text")
    texts = docs.withColumn("text", clean_title(F.col("text")))
    return keywords.term_counts(texts, title_tokens(F.col("text")), ["lang"]).groupBy("lang").agg(
        F.sum("tf").alias("tokens"), F.count(F.lit(1)).alias("distinct_tokens")
    )


@query
def keywords_global(spark, folder):
    return keywords.top_keywords(_documents(spark, folder), _latin_tokens(), 50, _stop(spark))


@query
def keywords_by_issue(spark, folder):
    return keywords.keywords_by(_documents(spark, folder), _latin_tokens(), "source", 10, _stop(spark))


@query
def keywords_by_category(spark, folder):
    return keywords.keywords_by(_documents(spark, folder), _latin_tokens(), "lang", 10, _stop(spark))


@query
def keywords_by_group(spark, folder):
    return keywords.groups_by_weight(keywords_by_category(spark, folder), "lang")


@query
def tfidf_l2_sum(spark, folder):
    return keywords.normalised_weights(_documents(spark, folder), "doc_id", _latin_tokens(), 20, _stop(spark))


@query
def keyword_flags_by_document(spark, folder):
    """0/1 per document and top keyword, in long form."""
    docs = _documents(spark, folder)
    found = features.keywords_of(docs, "text", _latin_tokens(), features.TITLE_KEYWORDS, _stop(spark))
    flags = keyword_flags(F.col("text"), found, "")
    pairs = F.array(*[F.struct(F.lit(w).alias("word"), f.alias("flag")) for w, f in zip(found, flags)])
    return docs.select("doc_id", F.inline(pairs))


QUERIES["clean_title"] = QUERIES.pop("clean_titles")
QUERIES["keyword_flags"] = QUERIES.pop("keyword_flags_by_document")


# ---- learning ----


def _series_input(spark: SparkSession, folder: str) -> DataFrame:
    return _as_like(issue_videos(spark, folder, ["week_number", "aid", "view", "like_cnt", "coin", "favorite"]))


def _series(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(statistics.weekly_series(_series_input(spark, folder)))


def _figures(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(_videos(spark, folder, ["aid", "view", "like_cnt", "coin", "favorite"]))


@query
def split_counts(spark, folder):
    return forecast.split_counts(statistics.weekly_series(_series_input(spark, folder)))


@query
def ols_weekly(spark, folder):
    series = _series(spark, folder)
    return forecast.coefficients(series, "avg_view").unionByName(forecast.coefficients(series, "avg_like"))


@query
def ols_fitted(spark, folder):
    return forecast.fitted(_series(spark, folder), "avg_view")


@query
def forecast_next4(spark, folder):
    return forecast.forecast(_series(spark, folder), "avg_view")


@query
def regression_metrics(spark, folder):
    return forecast.quality(_series(spark, folder), "avg_view")


@query
def kmeans_assign(spark, folder):
    return cluster.fit_clusters(_figures(spark, folder)).labelled.select("aid", "label")


@query
def kmeans_profile(spark, folder):
    profile = cluster.cluster_profile(cluster.fit_clusters(_figures(spark, folder)))
    return profile.withColumn("sample_ids", F.array_join(F.col("sample_ids").cast("array<string>"), ","))


@query
def kmeans_importance(spark, folder):
    found = cluster.fit_clusters(_figures(spark, folder))
    return spark.createDataFrame(list(cluster.feature_spread(found).items()), "feature STRING, importance DOUBLE")


@query
def pca_scatter(spark, folder):
    return cluster.scatter(cluster.fit_clusters(_figures(spark, folder)))


@query
def principal_axes(spark, folder):
    axes = cluster.principal_axes(_figures(spark, folder))
    return axes.withColumns({c: F.round(c, 5) for c in ["variance", "loading"]})


@query
def kmeans_conditions(spark, folder):
    return cluster.conditions(cluster.fit_clusters(_figures(spark, folder)))


# What makes a row of a table usable for features; `required` and the length filter ask for the same of the joined rows.
USABLE = {
    "part": "duration > 0 AND tid IS NOT NULL AND title IS NOT NULL",
    "orders": "pubdate IS NOT NULL",
    "supplier": "creator_name IS NOT NULL",
}


def _feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Trimmed videos with the raw columns the features are made of.

    Of the lines only keys and views are sent to their tables and to the choice of the last appearance; texts and the
    other columns are joined to the chosen rows.
    """
    order = ["week_number", *ORDER]
    needed = ["title", "duration", "tid", "pubdate", "creator_name"]
    lines = appearances(spark, folder, [*order, "view", *needed]).withColumnRenamed("creator_name", "up_name")
    last = features.trim_outliers(lines, order=order).select(*order, "view")
    columns = [*needed, "reason", "width", "height", "sub_category"]
    rows = relational.with_details(last, spark, folder, columns, USABLE)
    start, _ = relational.period(F.col("week_number"))
    return rows.withColumnsRenamed({"creator_name": "up_name", "reason": "rcmd_reason"}).withColumns(
        {
            "pubdate": utc_to_epoch(F.col("pubdate")),
            "week_stime": start,
            "desc": F.concat_ws(" ", "sub_category", "title"),
            "dynamic": F.when(F.col("l_linenumber") % 3 == 0, F.col("title")),
            "tidv2": F.when(F.col("l_linenumber") % 2 == 0, F.col("tid")),
            "is_pay": F.col("l_linenumber") % 2,
        }
    )


@query
def feature_engineering(spark, folder):
    rows = features.with_features(_feature_rows(spark, folder))
    rounded = ["duration_log", "view_log", "days_to_listing", "aspect_ratio"]
    exact = [
        "title_length", "desc_length", "has_dynamic", "has_rcmd_reason", "rcmd_reason_length", "publish_hour",
        "publish_weekday", "is_verified", "is_pay",
    ]
    return rows.select("aid", *exact, *[F.round(c, 6).alias(c) for c in rounded])


def _word_tokens(text):
    return words(F.lower(text), LATIN)


def _feature_data(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """The rows with all features, written once: keywords, category levels and models all read them."""
    kept = ["aid", "title", "rcmd_reason", features.TARGET, *features.CATEGORICAL, *features.NUMERICAL]
    rows = materialize(features.with_features(_feature_rows(spark, folder)).select(*kept))
    flagged, flags = features.with_keyword_flags(rows, _word_tokens)
    return features.complete(flagged).drop("title", "rcmd_reason"), flags


@query
def feature_matrix(spark, folder):
    """The complete rows; the keyword flags as their number per row, since their names depend on the data."""
    rows, flags = _feature_data(spark, folder)
    counts = {
        f"n_{p}": sum((F.col(f"`{f}`") for f in flags if f.startswith(p)), F.lit(0)) for p in ["title_kw", "rcmd_kw"]
    }
    hot = exploration.one_hot(rows, "publish_weekday", list(range(7)), "publish_weekday_")
    numbers = [F.round(F.col(c).cast("double"), 6).alias(c) for c in [features.TARGET, *features.NUMERICAL]]
    return hot.select(
        "aid", "tid", *[f"publish_weekday_{d}" for d in range(1, 7)], *numbers, *[c.alias(n) for n, c in counts.items()]
    )


def _learning_data(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(features.assemble(*_feature_data(spark, folder)))


@query
def model_comparison(spark, folder):
    return compare.compare(_learning_data(spark, folder))


@query
def param_search(spark, folder):
    return compare.search(_learning_data(spark, folder))


@query
def model_importance(spark, folder):
    data = _learning_data(spark, folder)
    return compare.importance(compare.models()["Random Forest"].fit(data), data)


@query
def residuals(spark, folder):
    data = _learning_data(spark, folder)
    return compare.residuals(compare.models()["Gradient Boosting"].fit(data), data)
