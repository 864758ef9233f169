from collections import Counter

from issuelens.llm import quality

from plain_words import WORD


def measures(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            repeated.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def of(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


def test_measures_agree_with_plain_python(documents, texts):
    rows = quality.quality(documents).collect()
    assert len(rows) == len(texts)
    assert all(of(row) == measures(texts[row.doc_id]) for row in rows)
    assert all(not row.kept for row in rows if row.base_failed)


def test_junk_goes_and_clean_documents_stay(spark, documents):
    clean = [row for row in documents.where("lang = 'en' AND n_chars > 2500").collect()]
    junk = [(10**6 + i, " ".join(w.strip(".,") + "###$$$" for w in r.text.split()[:400]), "en", "x", 1) for i, r in enumerate(clean[:5])]
    both = documents.unionByName(spark.createDataFrame(junk, documents.schema))
    kept = {row.doc_id: row for row in quality.quality(both).collect()}
    assert not any(kept[j[0]].kept for j in junk)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").collect()
    assert all(kept[row.doc_id].kept or kept[row.doc_id].base_failed for row in labels)


def test_odd_rows(odd_documents, no_documents):
    rows = quality.quality(odd_documents, min_docs=1).collect()
    assert len(rows) == odd_documents.count()
    assert sorted(map(of, rows)) == sorted(measures(row.text) for row in odd_documents.collect())
    assert quality.quality(no_documents).count() == 0


def test_distance_of_equal_and_disjoint_histograms(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        quality.js_distance(F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(0.5), F.lit(0.5))),
        quality.js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))),
    ).first()
    assert row[0] == 0 and abs(row[1] - 1) < 1e-12


def test_recall_and_false_rejections_on_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = quality.quality(spark.read.parquet(f"{folder}/documents.parquet"))
    labelled = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("quality", "kept", "base_failed").collect()
    junk = [row.kept for row in labelled if row.quality == 0]
    good = [row.kept for row in labelled if row.quality == 1 and not row.base_failed]
    assert len(junk) > 500 and sum(junk) <= 0.05 * len(junk)
    assert len(good) > 3000 and sum(not kept for kept in good) <= 0.01 * len(good)


def test_short_junk_goes(spark, documents):
    """Texts of 60 words between bars, and of 60 words with symbols at each."""
    long = [row for row in documents.where("lang = 'en' AND n_chars > 2500").limit(6).collect()]
    rare = [[w.strip(".,") for w in row.text.split() if len(w) > 6][:60] for row in long]
    texts = [" | ".join(words) for words in rare] + ["### ".join(words) for words in rare]
    junk = [(10**6 + i, text, "en", "x", len(text)) for i, text in enumerate(texts)]
    rows = quality.quality(documents.unionByName(spark.createDataFrame(junk, documents.schema))).where("doc_id >= 1000000").collect()
    assert len(rows) == len(junk) and not any(row.kept for row in rows)
