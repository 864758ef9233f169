import json
import random

import pytest
from pyspark.sql import functions as F

from raw_issues import issue, video
from issuelens.learning import cluster, compare, forecast
from issuelens.operators import flatten, statistics, warehouse
from issuelens.plans import jobs
from issuelens.plans.queries import QUERIES, _fact, _series_input
from issuelens.schemas import DWD_COLUMNS
from issuelens.sources import files, relational
from issuelens.sources.sinks import read_report, write_csv

STATS = [(100, 1100, 1, 10000, 500, 100, 200, 30, 50, 60), (101, 1101, 1, 20000, 1000, 200, 400, 50, 100, 120),
         (200, 1200, 2, 30000, 1500, 300, 600, 70, 150, 180)]


@pytest.fixture
def cleaned(spark, write_issues, tmp_path):
    def one(aid, mid, tid, *m):
        names = ["view", "like", "coin", "favorite", "share", "reply", "danmaku"]
        return video(aid, mid, tid, stat={"aid": aid, **dict(zip(names, m))})

    folder = write_issues(issue(1, [one(*s) for s in STATS[:2]]), issue(2, [one(*STATS[2])]))
    out = str(tmp_path / "clean")
    jobs.clean_job(spark, f"{folder}/week_*.json", out)
    return out


def test_statistics_of_three_videos(spark, cleaned):
    videos = statistics.join_tables(jobs.cleaned_tables(spark, cleaned))
    row = statistics.overall(videos).first()
    assert (row.total_videos, row.total_creators) == (3, 3)
    assert (row.avg_view, row.avg_like, row.avg_coin, row.avg_favorite, row.avg_share, row.avg_danmaku) == (
        20000, 1000, 200, 400, 50, 120
    )
    assert {r.tname: r.video_count for r in statistics.by_category(videos).collect()} == {"cat1": 2, "cat2": 1}
    assert [(r.week_number, r.video_count) for r in statistics.by_week(videos).collect()] == [(1, 2), (2, 1)]
    assert [r.mid for r in statistics.by_creator(videos).collect()] == [1100, 1101, 1200]


def test_report_files(spark, cleaned, tmp_path):
    jobs.statistics_job(spark, cleaned, str(tmp_path / "stats"))
    back = read_report(spark, str(tmp_path / "stats"), {"overall": "total_videos LONG, avg_view DOUBLE"})
    assert tuple(back["overall"].first()) == (3, 20000.0)
    jobs.keywords_job(spark, cleaned, str(tmp_path / "kw"))
    words = read_report(spark, str(tmp_path / "kw"), {"global": "word STRING, weight DOUBLE"})["global"].collect()
    assert {r.word for r in words} == {"video", "100", "101", "200"}


def test_csv_keeps_quotes_and_commas(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok')], "i INT, t STRING")
    write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert back.first().t == 'say "hi", ok'


def test_sums_over_weeks_equal_the_whole(spark, data):
    weeks = QUERIES["stats_by_week"](spark, data).agg(F.sum("video_count")).first()[0]
    assert weeks == QUERIES["stats_overall"](spark, data).first().total_videos


# ---- warehouse ----


def facts(spark, write_issues, *issues):
    raw = files.scan_issues(spark, write_issues(*issues))
    return warehouse.fact_from_records(flatten.normalised_records(flatten.video_rows(raw)))


def test_zero_views_give_zero_rates(spark, write_issues):
    row = facts(spark, write_issues, issue(1, [video(1, view=0)])).first()
    assert (row.like_rate, row.coin_rate, row.favorite_rate) == (0.0, 0.0, 0.0)


def test_latest_creator_name_everywhere(spark, write_issues):
    old = video(1, owner={"mid": 1, "name": "OldName"})
    new = video(2, owner={"mid": 1, "name": "NewName"})
    fact = facts(spark, write_issues, issue(998, [old]), issue(999, [new]))
    assert {r.up_name for r in fact.collect()} == {"NewName"}


def test_grain_with_a_video_in_three_issues(spark, write_issues):
    fact = facts(spark, write_issues, *[issue(n, [video(1), video(10 + n)]) for n in (1, 2, 1000)])
    assert fact.columns == DWD_COLUMNS
    assert fact.where("aid = 1").count() == 3
    assert fact.count() == fact.select("weekly_number", "aid").distinct().count() == 6


def test_both_ways_to_the_fact_agree(spark, data):
    rows = flatten.video_rows(relational.nested_issues(spark, data))
    slow = warehouse.fact_from_records(flatten.normalised_records(rows))
    fast = _fact(spark, data)
    assert slow.dtypes == fast.dtypes
    assert slow.exceptAll(fast).count() == 0 and fast.exceptAll(slow).count() == 0


def test_empty_fact_gives_typed_empty_tables(spark, data):
    fact = _fact(spark, data).limit(0)
    assert len(warehouse.dws_creator(fact).columns) == 14 and len(warehouse.dws_category(fact).columns) == 7
    weekly = warehouse.dws_weekly(fact)
    assert len(weekly.columns) == 9 and len(warehouse.ads_weekly_kpi(weekly, fact).columns) == 8
    assert len(warehouse.ads_hot_videos(fact).columns) == 13 and len(warehouse.ads_category_trend(fact).columns) == 5
    assert weekly.count() == warehouse.ads_hot_videos(fact).count() == 0


def test_warehouse_job_writes_eight_tables(spark, write_issues, tmp_path):
    folder = write_issues(issue(1, [video(1), video(2)]), issue(2, [video(1, view=5)]))
    (tmp_path / "raw" / "week_003.json").write_text("[oops", "utf-8")
    out = str(tmp_path / "wh")
    for _ in range(2):
        report = jobs.warehouse_job(spark, f"{folder}/week_*.json", out)
        assert report["weeks_processed"] == 2 and report["weeks_skipped"] == 1
        assert len(report["tables_written"]) == 8
    hot = files.scan_table(spark, out, "ads_hot_videos")
    assert {r.aid: r.view for r in hot.collect()} == {1: 5, 2: 1000}
    assert files.scan_table(spark, out, "dwd_fact_video").count() == 3


def test_warehouse_job_without_a_readable_file(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "week_001.json").write_text("nope", "utf-8")
    report = jobs.warehouse_job(spark, str(tmp_path / "raw" / "week_*.json"), str(tmp_path / "wh"))
    assert report == {"weeks_processed": 0, "weeks_skipped": 1, "tables_written": []}


# ---- learning ----


def three_groups(spark):
    draw = random.Random(42)
    ranges = [
        ((80_000, 120_000), (20_000, 30_000), (5000, 8000), (8000, 12_000)),
        ((40_000, 70_000), (1500, 3000), (400, 700), (800, 1500)),
        ((8000, 25_000), (200, 500), (50, 100), (100, 200)),
    ]
    rows = [(g * 10 + i, *[draw.randint(*r) for r in ranges[g]]) for g in range(3) for i in range(10)]
    return spark.createDataFrame(rows, "aid LONG, view LONG, like LONG, coin LONG, favorite LONG")


def test_clusters_of_three_groups(spark):
    found = cluster.fit_clusters(three_groups(spark))
    profile = cluster.cluster_profile(found).orderBy(F.desc("avg_view")).collect()
    assert [r["count"] for r in profile] == [10, 10, 10]
    assert [r.tag for r in profile] == cluster.TAGS
    assert profile[0].silhouette > 0 and profile[0].sample_ids == list(range(10))
    assert cluster.scatter(found).count() == 30
    assert set(cluster.feature_spread(found)) == set(cluster.FEATURES)


def test_too_few_videos_for_clusters(spark):
    found, few = cluster.fit_clusters(three_groups(spark)), cluster.fit_clusters(three_groups(spark).limit(2))
    assert few.model is None and cluster.feature_spread(few) == {}
    assert cluster.cluster_profile(few).count() == cluster.scatter(few).count() == 0
    assert cluster.cluster_profile(few).columns == cluster.cluster_profile(found).columns


def weekly(spark, weeks=10):
    draw = random.Random(0)
    rows = [(w, i, 10_000 + 2000 * w + draw.randint(-1000, 1000)) for w in range(1, weeks + 1) for i in range(5)]
    rows = [(w, w * 100 + i, v, v // 20, v // 100, v // 50) for w, i, v in rows]
    df = spark.createDataFrame(rows, "week_number INT, aid LONG, view LONG, like LONG, coin LONG, favorite LONG")
    return statistics.weekly_series(df)


def test_forecast_of_a_rising_series(spark):
    series = weekly(spark)
    assert forecast.fitted(series, "avg_view").count() == 10
    future = [tuple(r) for r in forecast.forecast(series, "avg_view").orderBy("week_number").collect()]
    assert [w for w, _ in future] == [11, 12, 13, 14]
    assert future[3][1] > future[0][1] > 25_000
    for r in forecast.quality(series, "avg_like").collect():
        assert r.r2 <= 1 and r.mae >= 0 and r.rmse >= 0


def test_too_few_weeks_for_a_line(spark):
    series, whole = weekly(spark, 5), weekly(spark)
    for report in (forecast.coefficients, forecast.fitted, forecast.forecast, forecast.quality):
        assert report(series, "avg_view").count() == 0
        assert report(series, "avg_view").columns == report(whole, "avg_view").columns


def test_folds_are_repeatable_and_complete(spark, data):
    videos = _series_input(spark, data).select("aid").distinct()
    folds = compare.with_folds(videos)
    again = compare.with_folds(videos.repartition(3))
    assert folds.exceptAll(again).count() == 0
    assert {r.fold for r in folds.select("fold").distinct().collect()} == {0, 1, 2, 3, 4}


def test_parameter_sample_stays_in_its_space():
    assert compare.sample_space(5) == compare.sample_space(5)
    for s in compare.sample_space(50):
        assert 3 <= s["maxDepth"] <= 10 and 0.01 <= s["stepSize"] <= 0.3 and 100 <= s["maxIter"] <= 500
        assert 0.6 <= float(s["featureSubsetStrategy"]) <= 1.0 and 1 <= s["minInstancesPerNode"] <= 10


def test_full_size_models():
    size = compare.Size()
    assert (size.forest_trees, size.forest_depth, size.boosting_rounds) == (200, 12, 300)


def test_default_sections_are_json(spark, cleaned, tmp_path):
    jobs.statistics_job(spark, cleaned, str(tmp_path / "s"))
    lines = [json.loads(x) for f in (tmp_path / "s" / "by_week").glob("*.json") for x in f.read_text().splitlines()]
    assert {x["week_number"] for x in lines} == {1, 2}


def test_registered_models_have_the_full_size(spark, monkeypatch):
    """The queries ask for the defaults: 200 trees of depth 12, 300 rounds of depth 6, 30 trials in the whole space."""
    from issuelens.plans import queries

    asked = {}

    class Fitted(Exception):
        pass

    def fit(estimator, data):
        asked[type(estimator).__name__] = estimator
        raise Fitted

    monkeypatch.setattr(queries, "_learning_data", lambda spark, folder: None)
    monkeypatch.setattr(compare, "compare", lambda data, size=compare.Size(): asked.update(size=size))
    monkeypatch.setattr(compare, "search", lambda data, trials=30, space=compare.SEARCH_SPACE: asked.update(trials=trials, space=space))
    for kind in (compare.RandomForestRegressor, compare.GBTRegressor):
        monkeypatch.setattr(kind, "fit", fit)
    queries.model_comparison(None, "")
    queries.param_search(None, "")
    for query in (queries.model_importance, queries.residuals):
        with pytest.raises(Fitted):
            query(None, "")
    forest, boosting = asked["RandomForestRegressor"], asked["GBTRegressor"]
    assert asked["size"] == compare.Size() and asked["trials"] == 30 and asked["space"] == compare.SEARCH_SPACE
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (200, 12)
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) == (300, 6, 0.05)


def test_principal_axes_agree_with_the_scatter(spark):
    videos = three_groups(spark)
    found = cluster.fit_clusters(videos)
    axes = {}
    for r in cluster.principal_axes(videos).collect():
        axes.setdefault(r.axis, {})[r.feature] = r.loading
    figures = videos.toPandas().set_index("aid")[cluster.FEATURES]
    scaled = (figures - figures.mean()) / figures.std()
    places = cluster.scatter(found).toPandas().set_index("aid").loc[figures.index]
    for axis, column in [(1, "x"), (2, "y")]:
        want = sum(scaled[f] * axes[axis][f] for f in cluster.FEATURES)
        sign = 1 if (want * places[column]).sum() > 0 else -1
        assert (want - sign * places[column]).abs().max() < 1e-3
        assert max(axes[axis].values(), key=abs) > 0


def test_principal_axes_of_odd_rows(spark):
    schema = "aid LONG, view LONG, `like` LONG, coin LONG, favorite LONG"
    assert cluster.principal_axes(spark.createDataFrame([], schema)).count() == 0
    assert cluster.principal_axes(spark.createDataFrame([(1, 5, 5, 5, 5)], schema)).count() == 0
    rows = [(i, i * 10, i, 7, None if i == 9 else 3 * i) for i in range(10)]
    loadings = {r.feature: r.loading for r in cluster.principal_axes(spark.createDataFrame(rows, schema), axes=1).collect()}
    assert loadings["coin"] == pytest.approx(0) and loadings["view"] == pytest.approx(3 ** -0.5)


def test_conditions_notice_wrong_labels(spark):
    found = cluster.fit_clusters(three_groups(spark))
    assert tuple(cluster.conditions(found).first()) == (30, 3, 0, 0)
    moved = cluster.Clustering(found.model, found.labelled.withColumn("label", F.lit(0)), 3)
    assert cluster.conditions(moved).first().misplaced == 20 and cluster.conditions(moved).first().empty == 2
    few = cluster.fit_clusters(three_groups(spark).limit(2))
    assert cluster.conditions(few).count() == 0
