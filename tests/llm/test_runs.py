import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain_words import WORD

from issuelens.llm import queries, runs


def brute(words):
    """All runs: stretches of equal words q apart, longest possible, with no smaller period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            length = k + q - start
            part = words[start : start + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def row_of(doc_id, words):
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    spare = {k for start, length, q in found for k in range(start + q, start + length)}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] if found else None,
        sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for k, w in enumerate(words) if k not in spare)),
    )


def planted(doc_id, words):
    """As the contract tells: each word i >= a becomes word a + (i - a) % p."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def got(frame):
    return sorted((tuple(r) for r in runs.digests(frame).collect()), key=repr)


def want(rows, edit=lambda i, words: words):
    return sorted((row_of(i, edit(i, WORD.findall(text or ""))) for i, text in rows), key=repr)


def strings():
    """Words over few letters, often with repeated parts."""
    part = st.lists(st.integers(0, 2), max_size=6)
    return st.lists(st.tuples(part, st.integers(1, 9)), max_size=5).map(lambda parts: [x for p, k in parts for x in p * k])


@settings(max_examples=200, deadline=None)
@given(st.lists(strings(), max_size=4), st.integers(1, 400))
def test_runs_of_some_texts_agree_with_brute_force(texts, at_once):
    runs_before, runs.CANDIDATES = runs.CANDIDATES, at_once
    try:
        found = runs.runs_of([[b"%d" % x for x in text] for text in texts]).to_pylist()
    finally:
        runs.CANDIDATES = runs_before
    assert [[tuple(r.values()) for r in row["runs"]] for row in found] == [brute(text) for text in texts]


@settings(max_examples=200, deadline=None)
@given(strings(), st.data())
def test_extensions_agree_with_plain_comparison(text, data):
    symbols = np.array([100, *text, 101])
    levels = runs.grammar(symbols)
    pairs = data.draw(st.lists(st.tuples(st.integers(0, len(symbols) - 1), st.integers(0, len(symbols) - 1)), max_size=20))
    pairs = [(a, b) for a, b in pairs if a != b]
    a, b = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))

    def plain(x, y, sign):
        n = 0
        while symbols[x + sign * n] == symbols[y + sign * n]:
            n += 1
        return n

    assert runs.extensions(levels, a, b).tolist() == [plain(x, y, 1) for x, y in pairs]
    assert runs.extensions(levels, a, b, False).tolist() == [plain(x, y, -1) for x, y in pairs]


def test_equal_symbols_of_the_grammar_are_equal_strings_and_levels_are_few():
    rng = random.Random(3)
    text = [rng.randrange(40) for _ in range(3000)] * 3 + [7] * 500
    levels = runs.grammar(np.array([100, *text, 101]))
    spans = [(k, k + 1) for k in range(len(text) + 2)]
    string, meaning = [100, *text, 101], {}
    for level in levels:
        for symbol, (first, last) in zip(level.symbols.tolist(), spans):
            content = tuple(string[first:last])
            assert meaning.setdefault(symbol, content) == content
        if level.up is not None:
            assert level.up[level.low].tolist() == list(range(len(level.low)))
            spans = [(spans[low][0], spans[high][1]) for low, high in zip(level.low, level.high)]
    assert len(set(meaning.values())) == len(meaning) and spans == spans[: len(levels[-1].symbols)]
    assert len(levels) < 120 and sum(len(level.symbols) for level in levels) < 9 * len(text)


def test_documents_agree_with_brute_force(documents, texts):
    assert got(runs.periodic_runs(documents)) == want(texts.items())


def test_query_agrees_with_brute_force(spark, data, texts):
    frame = queries.op11_periodic_runs(spark, data)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert frame.columns == names
    expected = want(texts.items(), planted)
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == expected
    assert sum(row[1] > 0 for row in expected) > 5


@pytest.mark.parametrize("group", [1 << 18, 50])
def test_odd_rows(odd_documents, no_documents, monkeypatch, group):
    monkeypatch.setattr(runs, "GROUP", group)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    # The very long text is one run; brute force takes too long on it.
    short = [r for r in rows if len(r[1] or "") < 100_000]
    found = got(runs.periodic_runs(odd_documents))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    long = (5, 1, 0, 60000, 1, 60_000_000, sha("0,60000,1\n"), sha("x"))
    assert found == sorted([*want(short), long], key=repr) and len(found) == len(rows)
    assert got(runs.periodic_runs(no_documents)) == []


def test_a_long_text_with_a_hot_word(spark):
    rng = random.Random(8)
    words = ["the" if rng.random() < 0.4 else f"w{rng.randrange(30)}" for _ in range(1500)]
    words[300:420] = words[300:330] * 4
    words[900:1400] = ["a", "b", "the", "a", "c"] * 100
    frame = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (None, "a\tb " * 9)], "doc_id long, text string")
    assert got(runs.periodic_runs(frame)) == want([(1, " ".join(words))] * 2 + [(None, "a\tb " * 9)])
