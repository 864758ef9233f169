import itertools
import zlib

import numpy as np

from issuelens.llm import language


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(1)
    for _ in range(100):
        sizes = rng.integers(0, 6, 4)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        if not sizes.sum():
            continue
        scores = rng.normal(size=(sizes.sum(), 3))
        label = language.viterbi(scores, np.minimum(starts, sizes.sum() - 1), sizes, 0.7)
        for start, size in zip(starts, sizes):
            worth = lambda path: sum(scores[start + i, l] for i, l in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731
            if size:
                assert abs(worth(label[start : start + size]) - max(map(worth, itertools.product(range(3), repeat=int(size))))) < 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {row.doc_id: row.lang for row in docs.collect()}
    rows = language.identify_languages(docs).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row.held_out]
    assert sum(row.lang_pred == truth[row.doc_id] for row in held) >= 0.97 * len(held)


def test_spans_of_a_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = {lang: docs.where(f"lang = '{lang}' AND n_chars BETWEEN 1000 AND 3000").orderBy("doc_id").first().text for lang in ("en", "de")}
    en, de = ([w for w in one[lang].split() if w.strip(".,").isalpha()][:60] for lang in ("en", "de"))
    frame = spark.createDataFrame([(1, False, " ".join(en + de)), (2, False, "Привет мир")], "doc_id long, held_out boolean, text string")
    model = language.learn(docs)
    mixed, cyrillic = language.predict(frame, model).orderBy("doc_id").collect()
    assert [span.lang for span in mixed.spans] == ["en", "de"]
    assert abs(mixed.spans[1].first_word - 60) <= 3 and sum(span.n_words for span in mixed.spans) == 120
    assert 0 < mixed.score < 1 and len(cyrillic.spans) == 1


def test_long_texts_are_cut_between_words(documents, monkeypatch):
    model = language.learn(documents)
    whole = language.identify([r.text for r in documents.limit(20).collect()], *model, 12.0)
    monkeypatch.setattr(language, "PIECE", 500)
    assert language.identify([r.text for r in documents.limit(20).collect()], *model, 12.0) == whole


def test_odd_rows(odd_documents, no_documents):
    rows = language.identify_languages(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (1, 2, 6))
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.held_out for r in rows if r.doc_id is None)
    assert language.identify_languages(no_documents).count() == 0
    unlabelled = odd_documents.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.identify_languages(unlabelled).collect()} == {"und"}


def test_every_label_is_learned(spark):
    """More labels than 256, the numbers of a byte, one of them far more frequent than the others."""
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = {f"l{k:03d}": ["".join(rng.choice(letters, 7)) for _ in range(6)] for k in range(300)}
    rows = [(k, lang, " ".join(words[lang] * 4)) for k, lang in enumerate(words)]
    rows += [(1000 + k, "l000", " ".join(words["l000"] * 2)) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.learn(docs, sample_docs=20)
    assert model[0] == sorted(words)
    found = language.identify([text for _, _, text in rows[:300]], *model, 12.0)
    assert [label for label, _, _ in found] == [lang for _, lang, _ in rows[:300]]


def test_a_label_has_at_most_its_sample(spark):
    docs = spark.createDataFrame([(k, "hot" if k % 100 else "rare", "ab") for k in range(4000)], "doc_id long, lang string, text string")
    _, log_p, _ = language.learn(docs, sample_docs=200)
    # Of `hot` about 200 texts are counted, of `rare` all 40: the ratio of their shares follows from the numbers.
    used = np.flatnonzero(log_p[:, 0] != log_p[:, 1])
    ratio = np.exp(log_p[used, 0] - log_p[used, 1]).max()
    assert 3.5 < ratio < 6.5
