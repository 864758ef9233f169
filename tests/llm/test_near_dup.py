from collections import defaultdict

import numpy as np
import pytest

from issuelens.llm import near_dup
from issuelens.llm.graph import components

from plain_words import LOWER, WORD


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(texts):
    """Component of each id."""
    sets, parent, postings, shared = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}, defaultdict(list), defaultdict(int)
    for k, s in sets.items():
        for x in s:
            postings[x].append(k)
    for ids in postings.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                shared[(b, a)] += 1

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {k: (len(sets[k]), root(k), root(k) == k) for k in texts}


@pytest.mark.parametrize("small", [16, 0])
def test_components_agree_with_brute_force(documents, texts, monkeypatch, small):
    monkeypatch.setattr(near_dup, "SMALL_GROUP", small)
    got = {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in near_dup.near_duplicates(documents).collect()}
    assert got == brute(texts)


def test_a_large_group_whose_members_differ_from_the_first(spark, monkeypatch):
    """Links that only members other than the smallest of a group have."""
    monkeypatch.setattr(near_dup, "SMALL_GROUP", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(30):
        words = list(base)
        # Runs of new words: far families share three quarters with their like and less with others.
        family = i % 3
        words[family * 60 : family * 60 + 40] = [f"f{family}x{k}" for k in range(40)]
        words[190 - i % 7] = f"own{i}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in near_dup.near_duplicates(frame).collect()}
    assert got == brute(texts)


def test_odd_rows(odd_documents, no_documents):
    rows = near_dup.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r.component_id for r in rows if r.doc_id == 3} == {3}
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id in (1, 2, 6)} == {(0, 1), (0, 2), (0, 6)}
    assert near_dup.near_duplicates(no_documents).count() == 0


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300, 5000):
        sketch = near_dup.sketches(np.zeros(n, dtype=np.int64), rng.integers(0, 2**63, n).astype(np.uint64), 1)
        assert (sketch != 2**64 - 1).all()
    common, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    value = np.concatenate((common, left, common, right))
    sketch = near_dup.sketches(np.repeat([0, 1], 700), value, 2)
    assert abs((sketch[0] == sketch[1]).mean() - 0.75) < 0.12


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert len(rows) == 60 and {r.component for r in rows if r.node <= 40} == {1} and {r.component for r in rows if r.node >= 100} == {100}


def test_texts_that_share_an_id_are_verified_each(spark):
    """Ids 5 (text A), 5 (text B), 7 (B and a word), 8 (A and a word): all are one component; 9 joins 3 by its second text."""
    text = lambda name: " ".join(f"{name}{k}" for k in range(120))
    a, b, c, d = map(text, "abcd")
    rows = [(5, a), (5, b), (7, b + " more"), (8, a + " more"), (3, c), (9, c + " more"), (9, d), (10, d + " more"), (11, text("e")), (None, a), (11, None), (5, a)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(frame).collect()), key=repr)
    of = {5: 5, 7: 5, 8: 5, 3: 3, 9: 3, 10: 3, 11: 11}
    assert got == sorted(((i, of.get(i), i is None or of[i] == i) for i, _ in rows), key=repr)
