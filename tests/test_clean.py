import datetime as dt
import json
import re

from pyspark.sql import functions as F

from raw_issues import issue, video
from issuelens.operators import cleaning, flatten
from issuelens.plans import jobs
from issuelens.plans.queries import QUERIES
from issuelens.schemas import ROW_KEY
from issuelens.sources import files, relational


def run(spark, folder, tmp_path):
    out = str(tmp_path / "clean")
    return jobs.clean_job(spark, f"{folder}/week_*.json", out), jobs.cleaned_tables(spark, out)


def test_two_issues_give_five_tables_in_step(spark, write_issues, tmp_path):
    folder = write_issues(*[issue(n, [video(n * 10 + i) for i in range(3)]) for n in (1, 2)])
    report, tables = run(spark, folder, tmp_path)
    assert report["total_weeks"] == 2 and report["total_videos"] == 6
    assert report["duplicates_dropped"] == 0 and report["outliers_flagged"] == 0
    keys = {name: {tuple(r) for r in t.select(*ROW_KEY).collect()} for name, t in tables.items() if name != "Weekly"}
    assert len(keys["Video"]) == 6 and all(k == keys["Video"] for k in keys.values())


def test_missing_values_become_zero_and_empty(spark, write_issues, tmp_path):
    sparse = video(1)
    del sparse["title"], sparse["stat"]["like"]
    report, tables = run(spark, write_issues(issue(1, [sparse])), tmp_path)
    assert report["missing_filled"] > 0
    assert tables["Video"].first().title == ""
    assert tables["VideoStat"].first()["like"] == 0.0


def test_duplicate_keeps_the_first_issue(spark, write_issues, tmp_path):
    folder = write_issues(issue(1, [video(100, view=1)]), issue(2, [video(100, view=2), video(101)]))
    report, tables = run(spark, folder, tmp_path)
    assert report["duplicates_dropped"] == 1 and report["total_videos"] == 2
    assert {(r.aid, r.week_number) for r in tables["Video"].collect()} == {(100, 1), (101, 2)}
    assert {r.view for r in tables["VideoStat"].where("aid = 100").collect()} == {1.0}


def test_negative_views_are_flagged_and_removed_everywhere(spark, write_issues, tmp_path):
    report, tables = run(spark, write_issues(issue(1, [video(1, view=-100), video(2)])), tmp_path)
    assert report["outliers_flagged"] == 1
    assert all(tables[t].count() == 1 for t in ("Video", "Creator", "Category", "VideoStat"))


def test_stored_types(spark, write_issues, tmp_path):
    _, tables = run(spark, write_issues(issue(1, [video(1)])), tmp_path)
    video_types, stat_types = dict(tables["Video"].dtypes), dict(tables["VideoStat"].dtypes)
    assert video_types["aid"] == video_types["duration"] == "bigint"
    assert stat_types["view"] == stat_types["like"] == "double"


def test_reason_is_only_probed_when_it_is_an_object(spark, write_issues, tmp_path):
    plain, rich = video(1, rcmd_reason="good"), video(2, rcmd_reason={"tid_v2": 7, "tname_v2": "x"})
    rows = flatten.video_rows(files.scan_issues(spark, write_issues(issue(1, [plain, rich]))))
    found = {r.aid: (r.reason_tid_v2, r.reason_tname_v2) for r in rows.collect()}
    assert found == {1: (None, None), 2: (7, "x")}


def test_bad_file_is_reported_and_the_rest_is_read(spark, write_issues, tmp_path):
    folder = write_issues(issue(1, [video(1)]), issue(1000, [video(2)]))
    (tmp_path / "raw" / "week_002.json").write_text("{not json", "utf-8")
    raw = files.scan_issues(spark, folder)
    assert [(r.week_number, r.error) for r in files.skipped_issues(raw).collect()] == [(2, "not a valid document")]
    good = files.good_issues(raw).orderBy("number").select("number", "file_number").collect()
    assert [tuple(r) for r in good] == [(1, 1), (1000, 1000)]


def test_issue_without_content_is_left_out(spark, write_issues):
    empty = {"number": 999, "config": {}, "videos": []}
    raw = files.scan_issues(spark, write_issues(empty, issue(1, [video(1)]), issue(2, [])))
    assert {r.number for r in flatten.issues_with_content(raw).collect()} == {1, 2}
    assert flatten.video_rows(raw).count() == 1
    assert flatten.weekly_records(flatten.issue_headers(raw)).count() == 3


def test_sparse_video_keeps_nulls_and_falls_back_to_its_own_id(spark, write_issues):
    raw = files.scan_issues(spark, write_issues({"number": 3, "config": {}, "videos": [{"aid": 1, "stat": {}, "owner": {}}]}))
    groups = flatten.normalised_records(flatten.video_rows(raw))
    stat = groups["video_stats"].first()
    assert stat.aid == 1 and stat.view is None
    assert groups["videos"].first().title is None
    assert groups["creators"].count() == 0


def test_creators_once_per_issue_first_wins(spark, write_issues):
    first = video(1, owner={"mid": 5, "name": "A", "face": "f"})
    second = video(2, owner={"mid": 5, "name": "B", "face": "f"})
    rows = flatten.video_rows(files.scan_issues(spark, write_issues(issue(1, [first, second]))))
    assert [(r.mid, r.name) for r in flatten.normalised_records(rows)["creators"].collect()] == [(5, "A")]


def test_field_mapping_of_one_video(spark, write_issues):
    known = video(
        46900196, 326257138, 250, 5391512, bvid="BV14b411J7ML",
        stat={"aid": 46900196, "view": 5391512, "like": 509422, "coin": 553737, "danmaku": 70080},
    )
    groups = flatten.normalised_records(flatten.video_rows(files.scan_issues(spark, write_issues(issue(1, [known])))))
    v, s = groups["videos"].first(), groups["video_stats"].first()
    assert (v.aid, v.bvid, v.creator_mid, v.category_tid) == (46900196, "BV14b411J7ML", 326257138, 250)
    assert (s.view, s.like_cnt, s.coin, s.danmaku) == (5391512, 509422, 553737, 70080)
    assert str(v.pubdate) == "2020-09-13 12:26:40"


def test_fill_and_cast_single_rows(spark):
    row = spark.createDataFrame([(None, None, None)], "aid LONG, view LONG, name STRING")
    filled = cleaning.fill_missing(cleaning.fill_missing(row, "VideoStat"), "Creator").first()
    assert tuple(filled) == (0, 0, "")
    typed = cleaning.convert_types(spark.createDataFrame([("1", "100")], "aid STRING, view STRING"), "VideoStat").first()
    assert typed.aid == 1 and typed.view == 100.0


def test_cleaning_is_idempotent(spark, data):
    rows = flatten.video_rows(relational.nested_issues(spark, data, gaps=True))
    once = cleaning.clean_rows(rows)
    assert cleaning.clean_rows(once).exceptAll(once).count() == 0


def test_infinite_and_missing_numbers_are_dropped(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, float("nan")), (4, None)], "id INT, x DOUBLE")
    assert [r.id for r in cleaning.drop_infinite(rows, ["x"]).collect()] == [1]


def test_ready_check_looks_at_columns(spark, write_issues, tmp_path):
    folder, out = write_issues(issue(1, [video(1)])), str(tmp_path / "clean")
    assert jobs.ensure_clean(spark, f"{folder}/week_*.json", out) is True
    assert jobs.ensure_clean(spark, f"{folder}/week_*.json", out) is False
    spark.range(1).select(F.col("id").alias("aid")).write.mode("overwrite").parquet(f"{out}/Video")
    assert jobs.ensure_clean(spark, f"{folder}/week_*.json", out) is True
    assert "week_number" in jobs.cleaned_tables(spark, out)["Video"].columns


def test_json_round_trip_keeps_every_video(spark, data, tmp_path):
    nested = relational.nested_issues(spark, data)
    whole = nested.groupBy("number").agg(F.min("first_pos").alias("_p")).join(nested, "number")
    target = tmp_path / "raw"
    target.mkdir()
    for row in whole.where("number IN (5, 6) AND first_pos = 0").select(F.to_json(F.struct("number", "config", "videos")).alias("j")).collect():
        doc = json.loads(row.j)
        (target / f"week_{doc['number']:03d}.json").write_text(row.j, "utf-8")
    read = flatten.video_rows(files.scan_issues(spark, str(target)))
    direct = flatten.video_rows(nested.where("number IN (5, 6) AND first_pos = 0"))
    assert read.exceptAll(direct).count() == 0 and read.count() == direct.count() > 0


def _tables(spark, folder):
    """Lines of two issues; one line lacks its part, one its order key, one order comes twice and one line has no date."""
    lines = [(k, n, k % 7, k % 3, float(k + n), dt.datetime(1995, 1 + n, 2), 5.0, 0.05, 0.02) for k in range(150) for n in range(2)]
    lines[40] = (20, 0, 99, 2, 20.0, dt.datetime(1995, 1, 2), 5.0, 0.05, 0.02)
    lines[60] = (None, 0, 1, 1, 30.0, dt.datetime(1995, 1, 2), 5.0, 0.05, 0.02)
    lines[80] = (40, 0, 5, 1, 40.0, None, 5.0, 0.05, 0.02)
    columns = "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_suppkey LONG, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"
    made = {
        "lineitem": (lines, f"{columns}, l_quantity DOUBLE, l_discount DOUBLE, l_tax DOUBLE"),
        "part": ([(k, f"name {k}", "brand", "type", k) for k in range(7)], "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT"),
        "supplier": ([(k, f"s{k}") for k in range(3)], "s_suppkey LONG, s_name STRING"),
        "orders": ([(k, dt.datetime(1995, 1, 1), "x") for k in [*range(150), 7]], "o_orderkey LONG, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return [x for x in lines if x[5] is not None]


def test_documents_do_not_depend_on_slices(spark, tmp_path, monkeypatch):
    lines = _tables(spark, str(tmp_path))
    expected = []
    for month in (1, 2):
        of_issue = sorted((x for x in lines if x[5].month == month), key=lambda x: (-1 if x[0] is None else x[0], x[1]))
        for first in range(0, len(of_issue), 50):
            found = [x for x in of_issue[first : first + 50] if x[0] is not None and x[2] < 7 for _ in range(1 + (x[0] == 7))]
            expected += [(month, first + i, x[0], x[2]) for i, x in enumerate(found)]
    for least in (1000, 20):
        monkeypatch.setattr(relational, "LEAST_LINES", least)
        rows = flatten.video_rows(relational.nested_issues(spark, str(tmp_path)))
        assert sorted((r.week_number, r.pos, r.cid, r.aid) for r in rows.collect()) == sorted(expected)


def test_lines_are_sent_once_for_parts_and_once_for_documents(spark, data):
    """Neither a global sort nor a shuffle of whole videos by issue."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = relational._placed_lines(spark, data)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    sent = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    # Lines by part, by supplier (a small table that is broadcast by default) and by slice; the dimensions; the counts.
    assert "rangepartitioning" not in text and len([x for x in sent if "_slice" in x]) == 2 and len(sent) <= 8


def test_details_neither_drop_nor_repeat_lines(spark, tmp_path):
    _tables(spark, str(tmp_path))
    lines = spark.createDataFrame([(7, 3, 1), (7, 0, 1), (None, 99, 9)], "l_orderkey LONG, aid LONG, l_suppkey LONG")
    usable = {"part": "duration > 0"}
    found = relational.with_details(lines, spark, str(tmp_path), ["title", "reason", "creator_name"], usable).collect()
    assert sorted((r.aid, r.title, r.reason, r.creator_name) for r in found) == [
        (0, None, "x", "s1"), (3, "name 3", "x", "s1"), (99, None, None, None)
    ]


def _sent(df):
    scans = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x]
    return {c for c in ("p_name", "s_name", "o_orderdate") if any(f"{c}:" in x.split("ReadSchema")[1] for x in scans)}


def test_documents_hold_and_send_only_the_fields_asked_for(spark, data, tmp_path):
    whole = relational.nested_issues(spark, data, True)
    some = relational.nested_issues(spark, data, True, ["aid", "owner"])
    assert some.schema == whole.schema
    fields = ["number", "first_pos", "config", "videos.aid", "videos.owner"]
    assert whole.select(fields).exceptAll(some.select(fields)).count() == 0 and some.count() == whole.count()
    assert some.select(F.explode("videos.title").alias("t")).where("t IS NOT NULL").count() == 0
    assert _sent(relational._placed_lines(spark, data, ["creator_name"])) == {"s_name"}
    # Lines without or with several rows in a table that gives no column still go or come again.
    _tables(spark, str(tmp_path))
    found = [
        sorted((r.week_number, r.pos, r.cid) for r in flatten.video_rows(relational.nested_issues(spark, str(tmp_path), fields=f)).collect())
        for f in (None, ["cid"])
    ]
    assert found[0] == found[1]


def test_cleaned_partner_tables_need_no_join(spark, data, tmp_path):
    def parts(folder):
        df = QUERIES["split_creator_clean"](spark, folder)
        return df, "LeftSemi" in df._jdf.queryExecution().optimizedPlan().toString()

    df, joined = parts(data)
    assert not joined
    rows = flatten.video_rows(relational.nested_issues(spark, data, True))
    by_join = cleaning.keep_rows_of(flatten.split_tables(rows)["Creator"], cleaning.clean_rows(rows))
    by_join = cleaning.convert_types(cleaning.fill_missing(by_join, "Creator"), "Creator")
    assert by_join.exceptAll(df).count() == 0 and by_join.count() == df.count() > 0
    # The order that comes twice makes a document run into the next one's places.
    _tables(spark, str(tmp_path))
    assert parts(str(tmp_path))[1]


def test_a_table_that_gives_no_column_is_not_joined_where_each_line_has_one_row(spark, data, tmp_path):
    def sent(folder, fields):
        wanted = [c for f in fields for c in relational.FIELD_COLUMNS.get(f, [])]
        plan = relational._placed_lines(spark, folder, wanted)._jdf.queryExecution().optimizedPlan().toString()
        # The figures are made of columns by multiplication.
        return {c for c, part in [("p_partkey", "#"), ("s_suppkey", "#"), ("l_quantity", r"#\d+ \*")] if re.search(c + part, plan)}

    assert sent(data, ["aid", "owner.mid"]) == set()
    assert sent(data, ["stat"]) == {"p_partkey", "l_quantity"} and sent(data, ["owner"]) == {"s_suppkey"}
    # One line lacks its part, none its supplier.
    _tables(spark, str(tmp_path))
    assert sent(str(tmp_path), ["aid"]) == {"p_partkey"}
    twice = spark.createDataFrame([(0, "s0"), (0, "s0"), (1, "s1"), (2, "s2"), (None, "s")], "s_suppkey LONG, s_name STRING")
    twice.write.mode("overwrite").parquet(f"{tmp_path}/supplier.parquet")
    assert sent(str(tmp_path), ["aid"]) == {"p_partkey", "s_suppkey"}
    some, whole = (flatten.video_rows(relational.nested_issues(spark, str(tmp_path), fields=f)) for f in (["cid", "owner.mid"], None))
    key = ["week_number", "pos", "cid", "mid"]
    assert some.select(key).exceptAll(whole.select(key)).count() == 0 and some.count() == whole.count() > 300
    assert some.where("up_name IS NOT NULL").count() == 0 < whole.where("up_name IS NOT NULL").count()
