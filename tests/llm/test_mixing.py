import itertools

from plain_words import WORD

from issuelens.llm import mixing


def targets(sizes):
    """Targets by sharing again and again, as the rule is told."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: w for s, w in zip(order, itertools.cycle((5, 2, 1)))}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        share = {s: (left - sum(fixed.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 2.0 * sizes[s] for s in over})


def check(docs, rows):
    source_of, sizes = {}, {}
    for row in docs.collect():
        source_of.setdefault(row.doc_id, row.source)
        sizes[row.source] = sizes.get(row.source, 0) + len(WORD.findall(row.text or ""))
    want, taken = targets(sizes), dict.fromkeys(sizes, 0)
    for row in rows:
        source = source_of[row.doc_id] if row.doc_id is not None else next(s for s in sizes if sizes[s] == row.source_size)
        assert row.source_size == sizes[source] and abs(row.target - want[source]) < 1e-6 * (1 + want[source])
        assert 0 <= row.taken <= 2 * row.size
        taken[source] += row.taken
    for source, total in taken.items():
        assert abs(total - want[source]) <= mixing.BLOCK + 1


def test_targets_and_taken_words(documents):
    rows = mixing.mix_sources(documents).collect()
    assert len(rows) == documents.count()
    check(documents, rows)


def test_reruns_agree_whatever_the_partitioning(documents):
    one = sorted(mixing.mix_sources(documents).collect())
    other = sorted(mixing.mix_sources(documents.repartition(7)).collect())
    assert one == other


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 3)
    monkeypatch.setattr(mixing, "BLOCK", 4)
    rows = mixing.mix_sources(documents).collect()
    by_source = {}
    for row in rows:
        by_source.setdefault((row.source_size, row.target), []).append(row.taken)
    # Shards whose quota is cut at twice their blocks may lose a block each.
    for (size, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 4 * 8


def test_highest_quotients(spark):
    votes = [53, 24, 23, 11, 0, 7]
    seats = 17
    frame = spark.createDataFrame([(1, i, v, seats) for i, v in enumerate(votes)], "g int, part int, votes int, seats long")
    got = {row.part: row.quota for row in mixing.apportion(frame, ["g"], "votes", "part").collect()}
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    assert got == dict(enumerate(won))


def test_odd_rows(odd_documents, no_documents):
    rows = mixing.mix_sources(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= row.taken <= 2 * row.size for row in rows)
    assert mixing.mix_sources(no_documents).count() == 0
