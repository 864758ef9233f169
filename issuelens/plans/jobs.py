"""Whole jobs: from raw files to cleaned tables, reports and the warehouse."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.functions.text import DOMAIN_WORDS, FEATURE_DOMAIN_WORDS, clean_title, title_tokens
from issuelens.learning import cluster, compare, features, forecast
from issuelens.operators import keywords, statistics, warehouse
from issuelens.operators.cleaning import clean_rows, cleaning_counts, convert_types, fill_missing
from issuelens.operators.flatten import (
    issue_headers,
    issues_with_content,
    normalised_records,
    split_tables,
    video_rows,
    weekly_table,
)
from issuelens.schemas import METRICS, ROW_KEY, TABLES
from issuelens.session import materialize
from issuelens.sources.files import good_issues, is_ready, scan_issues, scan_table, scan_words, skipped_issues
from issuelens.sources.sinks import publish_table, write_report, write_table

# The columns a cleaned dataset must have to be used without a rebuild.
READY = {"Weekly": ["number"], "Video": ["aid", "week_number"], "VideoStat": ["aid", *METRICS]}


def clean_job(spark: SparkSession, raw: str, out: str) -> dict[str, int]:
    """Raw files to the five cleaned tables; returns the numbers of the cleaning report.

    The numbers come from an aggregation of their own. Counters observed while the rows flow by
    would count a stage twice that a lost executor makes Spark repeat.
    """
    documents = issues_with_content(good_issues(scan_issues(spark, raw)))
    headers = issue_headers(documents)
    rows = video_rows(documents)
    kept = clean_rows(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = {"Weekly": weekly_table(headers).distinct(), **split_tables(kept)}
        for name in TABLES:
            write_table(convert_types(fill_missing(tables[name], name), name), f"{out}/{name}")
    finally:
        kept.unpersist()
    return cleaning_counts(rows, headers).first().asDict()


def ensure_clean(spark: SparkSession, raw: str, out: str) -> bool:
    """Rebuild the cleaned tables unless they are usable; tells whether it did."""
    if is_ready(spark, out, READY):
        return False
    clean_job(spark, raw, out)
    return True


def cleaned_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: scan_table(spark, folder, name) for name in TABLES}


def statistics_job(spark: SparkSession, clean: str, out: str) -> None:
    """The four sections of the statistics report; the joined videos are computed once."""
    videos = statistics.join_tables(cleaned_tables(spark, clean)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_report(
            {
                "overall": statistics.overall(videos),
                "by_category": statistics.by_category(videos),
                "by_creator": statistics.by_creator(videos),
                "by_week": statistics.by_week(videos),
            },
            out,
        )
    finally:
        videos.unpersist()


def cluster_job(spark: SparkSession, clean: str, out: str, k: int = 3) -> None:
    """Groups of the videos by their figures: profile of each group, importance of the figures, places in the plane.

    With fewer videos than groups the sections are written empty.
    """
    videos = statistics.join_tables(cleaned_tables(spark, clean)).select("aid", *cluster.FEATURES)
    found = cluster.fit_clusters(materialize(videos, "figures"), k)
    # One row per figure.
    spread = spark.createDataFrame(list(cluster.feature_spread(found).items()), "feature STRING, importance DOUBLE")
    write_report(
        {
            "clusters": cluster.cluster_profile(found),
            "importance": spread,
            "scatter": cluster.scatter(found),
            "axes": cluster.principal_axes(videos),
        },
        out,
    )


def forecast_job(spark: SparkSession, clean: str, out: str, targets: tuple[str, ...] = ("avg_view", "avg_like")) -> None:
    """The weekly line of each target: coefficients, fitted issues, the next issues, quality on kept-out issues.

    With too few issues the sections are written empty.
    """
    videos = statistics.join_tables(cleaned_tables(spark, clean))
    # One row per issue, read by every fit.
    series = materialize(statistics.weekly_series(videos), "series")
    sections = {"series": series.orderBy("week_number")}
    for target in targets:
        sections[f"{target}_line"] = forecast.coefficients(series, target)
        sections[f"{target}_fitted"] = forecast.fitted(series, target).orderBy("week_number")
        sections[f"{target}_next"] = forecast.forecast(series, target).orderBy("week_number")
        sections[f"{target}_quality"] = forecast.quality(series, target)
    write_report(sections, out)


def feature_tokens(text: Column) -> Column:
    """Tokens of a title for features, with the words that only feature extraction keeps whole."""
    return title_tokens(text, [*DOMAIN_WORDS, *FEATURE_DOMAIN_WORDS])


def learning_rows(spark: SparkSession, raw: str) -> DataFrame:
    """Raw files to rows (aid, features, label); keywords leave out the stop words of feature extraction."""
    rows = video_rows(issues_with_content(good_issues(scan_issues(spark, raw))))
    made = materialize(features.with_features(features.trim_outliers(rows)), "features")
    stop = spark.createDataFrame([(w,) for w in keywords.FEATURE_STOP_WORDS], "token STRING")
    flagged, flags = features.with_keyword_flags(made, feature_tokens, stop)
    return materialize(features.assemble(features.complete(flagged), flags), "learning")


def models_job(
    spark: SparkSession, raw: str, out: str, size: compare.Size = compare.Size(), trials: int = 30, space: dict = compare.SEARCH_SPACE
) -> None:
    """The model comparison: models, name and settings of the best, trials, and importances and residuals of the best model."""
    write_report(compare.report(learning_rows(spark, raw), size, trials, space), out)


def keywords_job(spark: SparkSession, clean: str, out: str) -> None:
    """Keywords of the titles: of all, by issue, by category (categories with the weightiest words first)."""
    category = scan_table(spark, clean, "Category").select(*ROW_KEY, "tname")
    titles = scan_table(spark, clean, "Video").join(category, ROW_KEY, "left").select(
        "week_number", "tname", clean_title(F.col("title")).alias("title")
    )
    tokens, stop = title_tokens(F.col("title")), scan_words(spark)
    by_category = keywords.keywords_by(titles, tokens, "tname", 10, stop)
    write_report(
        {
            "global": keywords.top_keywords(titles, tokens, 50, stop),
            "by_week": keywords.keywords_by(titles, tokens, "week_number", 10, stop).orderBy("week_number", "rank"),
            "by_category": keywords.groups_by_weight(by_category, "tname"),
        },
        out,
    )


def warehouse_job(spark: SparkSession, raw: str, out: str) -> dict:
    """Raw files to the eight warehouse tables; the summaries read the written fact, not the files.

    The unreadable issues are listed in `skipped_details`.
    """
    documents = scan_issues(spark, raw)
    skipped_issues(documents).write.mode("overwrite").json(f"{out}/skipped_details")
    good = good_issues(documents)
    processed = good.select("number").distinct().count()
    skipped = spark.read.schema("week_number INT, error STRING").json(f"{out}/skipped_details").count()
    report = {"weeks_processed": processed, "weeks_skipped": skipped, "tables_written": []}
    if processed == 0:
        return report

    def publish(name: str, df: DataFrame, partition: str | None = None) -> None:
        publish_table(df, f"{out}/{name}", partition)
        report["tables_written"].append(name)

    groups = normalised_records(video_rows(good))
    publish("dwd_fact_video", warehouse.fact_from_records(groups), "weekly_number")
    fact = scan_table(spark, out, "dwd_fact_video")
    publish("dws_creator", warehouse.dws_creator(fact))
    publish("dws_category", warehouse.dws_category(fact))
    publish("dws_weekly", warehouse.dws_weekly(fact))
    publish("ads_hot_videos", warehouse.ads_hot_videos(fact))
    publish("ads_top_creators", warehouse.ads_top_creators(scan_table(spark, out, "dws_creator")))
    publish("ads_category_trend", warehouse.ads_category_trend(fact))
    publish("ads_weekly_kpi", warehouse.ads_weekly_kpi(scan_table(spark, out, "dws_weekly"), fact))
    return report
