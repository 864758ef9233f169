import pytest

from issuelens.operators import browse


@pytest.fixture(scope="module")
def lib(spark):
    """Videos with ties and missing figures; the creators share them unevenly."""
    figures = [(aid, None if aid % 5 == 0 else aid % 3 * 100, aid % 2) for aid in range(1, 24)]
    return browse.Library(
        weekly=spark.createDataFrame([(1, "a"), (2, "b")], "number INT, name STRING"),
        creator=spark.createDataFrame([(m, f"c{m}", "") for m in range(1, 8)], "mid LONG, name STRING, face STRING"),
        category=spark.createDataFrame([(1, "x", "y")], "tid INT, tname STRING, tname_v2 STRING"),
        video=spark.createDataFrame(
            [(a, f"BV{a}", f"t{a}", "", 60, a * 10, a * a % 6 + 1, 1) for a, _, _ in figures],
            "aid LONG, bvid STRING, title STRING, cover_url STRING, duration INT, pubdate LONG, creator_mid LONG, category_tid INT",
        ),
        video_stat=spark.createDataFrame(figures, "aid LONG, view LONG, like_cnt LONG"),
        weekly_video=spark.createDataFrame([(1 + a % 2, a) for a, _, _ in figures], "weekly_number INT, aid LONG"),
    )


def walk(after, mark):
    """All rows of a listing, page after page."""
    rows, last = [], None
    while page := after(last).collect():
        rows += page
        last = mark(page[-1])
    return rows


@pytest.mark.parametrize("by", ["view", "like", "pubdate"])
def test_seeking_walks_through_the_same_pages(lib, by):
    column = browse.VIDEO_ORDER[by]
    sought = walk(lambda last: browse.video_page_after(lib, last, 6, by), lambda r: (r[column], r.aid))
    counted = [r for page in range(1, 5) for r in browse.video_page(lib, page, 6, by).collect()]
    assert len(sought) == 23 and sought == counted


def test_seeking_with_a_filter(lib):
    sought = walk(lambda last: browse.video_page_after(lib, last, 4, week=1), lambda r: (r.view, r.aid))
    assert sought == browse.video_page(lib, 1, 100, week=1).collect() and len(sought) == 11


@pytest.mark.parametrize("by", ["video_count", "total_views"])
def test_seeking_creators(lib, by):
    sought = walk(lambda last: browse.creators_page_after(lib, last, 2, by), lambda r: (r[by], r.mid))
    assert sought == browse.creators_page(lib, 1, 100, by).collect() and len(sought) == 7


def test_a_deep_page_keeps_a_page_of_rows(lib):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "TakeOrderedAndProject(limit=5," in plan(browse.video_page_after(lib, (100, 7), 5))
