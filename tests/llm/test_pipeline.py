import corpus_pipeline
import pytest

from issuelens.llm import near_dup, quality, repeats


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """The documents and what each stage makes of them."""
    base = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{data}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], data).write.parquet(f"{base}/{k}")
        frames.append(spark.read.parquet(f"{base}/{k}"))
    return frames


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(frame.columns == corpus_pipeline.COLUMNS for frame in stages[1:-1])


def test_quality_stage_keeps_what_the_rules_keep(stages):
    kept = {r.doc_id for r in quality.quality(stages[0]).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept
    assert stages[1].join(stages[0], corpus_pipeline.COLUMNS, "left_anti").count() == 0


def test_one_document_of_each_group_stays(stages):
    left = near_dup.near_duplicates(stages[2])
    assert left.where("NOT kept").count() == 0
    assert {r.doc_id for r in near_dup.near_duplicates(stages[1]).where("kept").collect()} == {r.doc_id for r in stages[2].collect()}


def test_no_long_passage_is_left_twice(stages):
    cut = {r.doc: r.kept_text for r in repeats.remove_repeats(stages[2]).collect()}
    assert {r.doc_id: r.text for r in stages[3].collect()} == {k: t for k, t in cut.items() if t.strip()}


def test_mix_repeats_documents_at_most_twice(stages):
    counts = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert max(counts.values()) <= 2 and set(counts) <= {r.doc_id for r in stages[3].collect()}


def test_ids_decode_to_the_texts(stages):
    assert stages[5].count() == stages[4].count() and stages[5].where("NOT round_trip").count() == 0


def test_odd_and_no_rows(spark, data, odd_documents, no_documents):
    for docs in (odd_documents.select(corpus_pipeline.COLUMNS), no_documents):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, data).count() >= 0
