from pyspark.sql import functions as F

from raw_issues import issue, video
from issuelens.plans.queries import QUERIES, STREAM_BATCHES
from issuelens.sources import relational
from issuelens.streaming import ingest


def statuses(spark, out):
    return sorted((r.number, r.status) for r in spark.read.parquet(f"{out}/status").collect())


def run(spark, folder, tmp_path):
    query = ingest.ingest(spark, folder, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return query


def test_only_new_files_are_loaded(spark, write_issues, tmp_path):
    folder, out = write_issues(issue(1, [video(1, view=1), video(2)])), str(tmp_path / "out")
    (tmp_path / "raw" / "week_009.json").write_text("{broken", "utf-8")
    run(spark, folder, tmp_path)
    assert statuses(spark, out) == [(1, "loaded"), (9, "failed")]
    again = run(spark, folder, tmp_path)
    assert not any(p["numInputRows"] for p in again.recentProgress)
    write_issues(issue(2, [video(1, view=7, owner={"mid": 1001, "name": "renamed"}), video(3)]))
    run(spark, folder, tmp_path)
    assert (2, "loaded") in statuses(spark, out)
    assert {r.aid: r.view for r in ingest.current(spark, out, "video_stats").collect()} == {1: 7, 2: 1000, 3: 1000}
    assert ingest.current(spark, out, "creators").where("mid = 1001").first().name == "up1001"
    assert ingest.current(spark, out, "weekly_videos").count() == 4
    assert ingest.current(spark, out, "weekly").count() == 2


def test_known_issue_is_skipped_and_a_repeated_batch_changes_nothing(spark, write_issues, tmp_path):
    from issuelens.sources.files import scan_issues

    folder, out = write_issues(issue(1, [video(1), video(2)])), str(tmp_path / "out")
    raw = scan_issues(spark, folder)
    ingest.load_batch(raw, 0, out)
    first = ingest.current(spark, out, "videos").collect()
    ingest.load_batch(raw, 0, out)
    assert statuses(spark, out) == [(1, "loaded")]
    ingest.load_batch(raw, 1, out)
    assert statuses(spark, out) == [(1, "loaded"), (1, "skipped")]
    assert sorted(ingest.current(spark, out, "videos").collect()) == sorted(first)


def test_rows_of_few_issues_are_written_where_they_are_read(spark, write_issues, tmp_path, monkeypatch):
    from issuelens.sources.files import scan_issues

    raw = scan_issues(spark, write_issues(issue(1, [video(1), video(2)]), issue(2, [video(3)])))
    sent, write = {}, ingest.replace_partitions

    def spy(df, path, partition, send=True):
        sent[path.rsplit("/")[-1]] = send
        write(df, path, partition, send)

    monkeypatch.setattr(ingest, "replace_partitions", spy)
    found = []
    for few in (2, 1):
        monkeypatch.setattr(ingest, "FEW_ISSUES", few)
        out = str(tmp_path / f"few{few}")
        for _ in range(2):
            ingest.load_batch(raw, 0, out)
        assert {name for name, by_shuffle in sent.items() if not by_shuffle} == (set(ingest.WIDE) if few == 2 else set())
        found.append([sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) for name in ingest.GROUPS])
    assert found[0] == found[1] and len(found[0][2]) == 3


def test_replayed_documents_are_written_where_they_are_made(spark, data):
    figures = QUERIES["stream_replayed"](spark, data)
    base = figures.inputFiles()[0].split("/out/")[0]
    arriving = spark.read.parquet(f"{base}/arriving")
    documents = relational.nested_issues(spark, data)
    assert arriving.count() == documents.count()
    batches = {r.number: r.found for r in arriving.groupBy("number").agg(F.collect_set("batch").alias("found")).collect()}
    in_order = [batches[n] for n in sorted(batches)]
    assert all(len(x) == 1 for x in in_order) and in_order == sorted(in_order) and len(set(map(tuple, in_order))) == STREAM_BATCHES
    # Both turns loaded each issue with the batch of its folder.
    status = {r.number: (r.status, [r.batch]) for r in spark.read.parquet(f"{base}/out/status").collect()}
    assert status == {n: ("loaded", x) for n, x in batches.items()}
