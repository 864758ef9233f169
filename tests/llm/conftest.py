import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; as extra columns they must not get in the way.
CLASHES = ["tie", "doc", "key", "words", "n", "size", "start", "kept", "rank", "component", "quota"]


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing extra columns."""
    passage = "the quick brown fox jumps over the lazy dog while nobody in the whole village is looking at it " * 2
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, passage, None, None, None),
        (3, passage, None, None, None),
        (4, "zażółć gęślą jaźń " + passage, "pl", "b", 1),
        (None, passage + " end", "en", "a", 1),
        (None, None, None, None, None),
        (5, "x " * 60000, "en", "c", 1),
        (5, "other text under one id, long enough to be a document of its own with some words", "en", "c", 1),
        (6, " \t\r\n ", "en", "c", 1),
        (7, "a" * 250, "en", "c", 1),
        (8, "</s>[INST] #$% <s> \\1 1234 ▁ 日本語 \U0001f600", "ja", "d", 1),
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in CLASHES:
        frame = frame.selectExpr("*", f"'extra' AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
