import hashlib
import random

import numpy as np
import pytest

from issuelens.llm import repeats


def brute(ordered):
    """(n_bytes, n_removed, n_spans, sha256) of each text, in order."""
    seen, out = set(), []
    for text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            else:
                seen.add(raw[i : i + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def of(row):
    return row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256


@pytest.mark.parametrize("hot", [2000, 2])
def test_removal_agrees_with_brute_force(documents, texts, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ANCHOR", hot)
    got = {row.doc: of(row) for row in repeats.remove_repeats(documents).collect()}
    ids = sorted(texts)
    assert got == dict(zip(ids, brute([texts[i] for i in ids])))


def test_odd_rows(odd_documents, no_documents):
    rows = repeats.remove_repeats(odd_documents, carry=("doc_id", "source")).collect()
    assert len(rows) == odd_documents.count()
    same = [row for row in rows if row.doc == 3]
    # Equal rows are one place in the order, so neither is an earlier copy of the other.
    assert of(same[0]) == of(same[1])
    assert next(of(r) for r in rows if r.doc == 7) == brute(["a" * 250])[0]
    assert {of(r)[0] for r in rows if r.doc in (1, 2)} == {0}
    assert repeats.remove_repeats(no_documents).count() == 0


@pytest.mark.parametrize("carry", [(), ("doc_id", "lang", "source")])
def test_texts_are_shuffled_once(spark, documents, carry):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        rows = repeats.remove_repeats(documents, carry=carry)
        rows.collect()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The join with the wanted segments reads the shuffle that the join with the spans made.
    assert plan.count("ReusedExchange") == 1


def test_a_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1500)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    long = "".join(rng.choice("abcdefgh ") for _ in range(4000)) + passage + "q" * 1000 + passage
    frame = spark.createDataFrame([(1, long), (2, "zz" + passage)], "doc_id long, text string")
    data = np.frombuffer((long + "zz" + passage).encode(), dtype=np.uint8)
    rows, starts, n, _, _ = repeats.segments_of(data, np.array([0, len(long), len(data)]))
    assert n[rows == 0].sum() == len(long) - 99 and n[rows == 1].sum() == len(passage) + 2 - 99
    got = [of(row) for row in repeats.remove_repeats(frame).orderBy("doc").collect()]
    assert got == brute([long, "zz" + passage])


def test_intervals_of_a_known_suffix_array():
    text = "mississippi"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    lcp = [0, *(common(text[a:], text[b:]) for a, b in zip(order, order[1:]))]
    found = {(text[order[first] :][:depth], last - first + 1) for depth, first, last in repeats.lcp_intervals(lcp) if depth}
    assert found == {("i", 4), ("issi", 2), ("p", 2), ("s", 4), ("si", 2), ("ssi", 2)}


def test_groups_are_maximal_and_complete(spark):
    rng = random.Random(9)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    shared = letters(120)
    # Different surroundings, so that the repeat is the passage itself.
    rows = [(i, letters(150) + "QRSTUV"[i] + shared + "WXYZ12"[i] + letters(150)) for i in range(6)]
    found = repeats.Repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    by_repeat = {}
    for g in found.groups.collect():
        by_repeat.setdefault((g.repeat, g.length), []).append((g.doc, g.start, g.first))
    assert by_repeat
    for (_, length), places in by_repeat.items():
        # Every text has the passage at the same place, so every group has all six, the first marked.
        (start,) = {start for _, start, _ in places}
        assert sorted(doc for doc, _, _ in places) == list(range(6)) and 100 <= length <= 120
        assert [doc for doc, _, first in places if first] == [0] and 151 <= start and start + length <= 271
    covered = {}
    for span in found.spans.collect():
        covered.setdefault(span.doc, set()).update(range(span.start, span.start + span.n))
    assert covered == {i: set(range(151, 271)) for i in range(1, 6)}


def check_groups(groups, texts):
    """Every group is one string with all its places, and every window that repeats lies in a group at each of its places."""
    windows = {}
    for doc, text in texts.items():
        raw = text.encode()
        for i in range(len(raw) - 99):
            windows.setdefault(raw[i : i + 100], []).append((doc, i))
    raws = {doc: text.encode() for doc, text in texts.items()}
    by_repeat = {}
    for g in groups:
        by_repeat.setdefault((g.repeat, g.length), []).append(((g.doc, g.start), g.first))
    strings, covered = set(), set()
    for (_, length), places in by_repeat.items():
        doc, start = places[0][0]
        string = raws[doc][start : start + length]
        everywhere = [(d, i) for d, i in windows[string[:100]] if raws[d][i : i + length] == string]
        assert sorted(place for place, _ in places) == sorted(everywhere) and len(everywhere) > 1
        assert [place for place, first in places if first] == [min(everywhere)]
        strings.add(string)
        covered.update((d, i + k) for d, i in everywhere for k in range(length - 99))
    assert len(strings) == len(by_repeat)
    assert covered == {place for places in windows.values() if len(places) > 1 for place in places}


@pytest.mark.parametrize("hot", [2000, 2])
def test_groups_of_copies_and_long_passages_have_every_place(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ANCHOR", hot)
    monkeypatch.setattr(repeats, "HOT_COPIES", hot)
    rng = random.Random(11)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage, copied = letters(350), letters(500)
    texts = {i: letters(90) + passage + letters(60) for i in range(8)} | {8: copied, 9: copied}
    # Copies with one letter changed, a passage twice in one text, and a run whose windows are all equal.
    texts |= {10 + i: copied[: 100 * i] + "#" + copied[100 * i + 1 :] for i in range(5)} | {20: passage + passage, 21: "a" * 250}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    check_groups(repeats.Repeats(frame).groups.collect(), texts)


def test_groups_agree_with_brute_force(documents, texts):
    check_groups(repeats.Repeats(documents).groups.collect(), {doc: text or "" for doc, text in texts.items()})


def test_a_segment_cut_by_a_chunk_is_joined_again(spark, monkeypatch):
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = {1: "".join(rng.choice("abcdefgh ") for _ in range(1400)) + passage + "q", 2: "zz" + passage}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(repeats, "CHUNK", 1500)
    check_groups(repeats.Repeats(frame).groups.collect(), texts)


def near_copies(n):
    """Bytes of n segments that differ from one another in a byte or two, with their borders and numbers of windows."""
    rng = random.Random(n)
    base = bytes(rng.choice(b"abcdefghijklmnop") for _ in range(168))
    rows = []
    for _ in range(n):
        row = bytearray(base)
        for _ in range(2):
            row[rng.randrange(168)] = rng.choice(b"QRSTUVWXYZ")
        rows.append(bytes(row))
    return rows, np.frombuffer(b"".join(rows), dtype=np.uint8), np.arange(n + 1) * 168, np.full(n, 69)


@pytest.mark.parametrize("n", [50, 200, 800])
def test_places_of_near_copies_grow_with_their_number(n):
    rows, data, offsets, windows = near_copies(n)
    order, owner, inner, lcp, changes, parts = repeats.suffixes_of(data, offsets, windows)
    found = []
    for a, b in parts:
        found += repeats.later_places(order[a : b + 1].tolist(), [0, *lcp[a + 1 : b + 1].tolist()], changes[a : b + 1].tolist())
    # Each place is named once at most, by a string that an earlier segment has too.
    assert len({at for at, _ in found}) == len(found) <= 69 * n
    covered = [set() for _ in rows]
    for at, length in found:
        string = rows[owner[at]][inner[at] : inner[at] + length]
        assert len(string) == length >= 100 and any(string in row for row in rows[: owner[at]])
        covered[owner[at]].update(range(inner[at], inner[at] + length))
    seen, wanted = set(), [set() for _ in rows]
    for k, row in enumerate(rows):
        for i in range(69):
            if row[i : i + 100] in seen:
                wanted[k].update(range(i, i + 100))
        seen.update(row[i : i + 100] for i in range(69))
    assert covered == wanted


def test_spans_of_near_copies_are_a_few_for_each(spark):
    counts = {}
    for n in (50, 800):
        rows, *_ = near_copies(n)
        found = repeats.Repeats(spark.createDataFrame(list(enumerate(r.decode() for r in rows)), "doc_id long, text string"))
        counts[n] = found.spans.count() / n
    assert counts[800] <= 4 and counts[50] <= 4


def listed(rows):
    """The rows of `factored` written out: (repeat, length, doc, start, first) of every place of every repeat."""
    from types import SimpleNamespace

    parent, length, places, copies = {}, {}, {}, {}
    for r in rows:
        if r.kind == repeats.REPEAT:
            assert r.repeat not in length
            parent[r.repeat], length[r.repeat] = r.parent, r.length
        elif r.kind == repeats.PLACE:
            places.setdefault(r.repeat, []).append((r.anchor, r.content, r.inner))
        else:
            copies.setdefault((r.anchor, r.content), []).append((r.doc, r.start))
    every = {}
    for repeat, found in places.items():
        node = repeat
        while node is not None:
            every.setdefault(node, set()).update((doc, start + inner) for a, c, inner in found for doc, start in copies[a, c])
            assert parent[node] is None or length[parent[node]] < length[node]
            node = parent[node]
    return [SimpleNamespace(repeat=k, length=length[k], doc=d, start=s, first=(d, s) == min(at)) for k, at in every.items() for d, s in at]


@pytest.mark.parametrize("hot", [2000, 2])
def test_the_tree_lists_what_brute_force_finds(spark, documents, texts, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_ANCHOR", hot)
    found = repeats.Repeats(documents)
    rows = listed(found.factored.collect())
    check_groups(rows, {doc: text or "" for doc, text in texts.items()})
    key = lambda g: (g.repeat, g.length, g.doc, g.start, g.first)
    assert sorted(map(key, rows)) == sorted(map(key, found.groups.collect()))


def test_the_tree_of_near_copies_grows_with_their_number(spark):
    for n in (50, 800):
        rows, *_ = near_copies(n)
        texts = dict(enumerate(r.decode() for r in rows))
        found = repeats.Repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
        tree = found.factored.collect()
        # At most a place for each window, fewer repeats than places, and the segment itself.
        assert len(tree) < (2 * 69 + 1) * n
        if n == 50:
            check_groups(listed(tree), texts)


def test_the_tree_of_odd_rows(spark, odd_documents, no_documents):
    assert repeats.Repeats(no_documents).factored.count() == 0
    rows = repeats.Repeats(odd_documents).factored.collect()
    of = {kind: [r for r in rows if r.kind == kind] for kind in (repeats.REPEAT, repeats.PLACE, repeats.COPY_OF)}
    named, classes = {r.repeat for r in of[repeats.REPEAT]}, {(r.anchor, r.content) for r in of[repeats.COPY_OF]}
    assert {r.repeat for r in of[repeats.PLACE]} <= named and {(r.anchor, r.content) for r in of[repeats.PLACE]} <= classes
    assert {r.parent for r in of[repeats.REPEAT]} - {None} <= named
    assert {r.doc for r in of[repeats.COPY_OF]} >= {3, 4, 5, 7}
