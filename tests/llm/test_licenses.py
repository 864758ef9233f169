import re

import pytest

from issuelens.llm import licenses


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_scan_finds_what_plain_comparison_finds(spark, documents):
    mit = licenses.TEMPLATES["MIT"][1]
    apache = licenses.TEMPLATES["Apache-2.0"][1]
    cut = " ".join(apache.split()[8:])
    more = [(10**6, f"code code code {mit} end of it", None, None, 0), (10**6 + 1, "some words before " + cut, None, None, 0)]
    docs = documents.unionByName(spark.createDataFrame(more, documents.schema))
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect()}
    want = set()
    for row in docs.collect():
        own = shingles(row.text or "")
        for name, templates in licenses.TEMPLATES.items():
            for template in templates:
                if len(shingles(template) & own) >= 0.75 * len(shingles(template)):
                    want.add((row.doc_id, name))
    assert got == want and (10**6, "MIT") in got and (10**6 + 1, "Apache-2.0") in got


def test_place_and_containment(spark):
    text = "one two three four five six seven. Released under the MIT License."
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row.license, row.containment) == ("MIT", 1.0) and 6 <= row.first_word <= 7


def test_odd_rows(odd_documents, no_documents):
    assert licenses.scan(odd_documents).count() == 0
    assert licenses.scan(no_documents).count() == 0


def test_short_templates_are_refused(documents):
    with pytest.raises(ValueError):
        licenses.scan(documents, {"tiny": ["too short"]})
