"""Near duplicates: fast similarity sketches, banding, and exact verification on full shingle sets.

A document's set is its distinct 5-word shingles after lower-casing A-Z. Documents with equal sets
form a class; only one of a class is sketched on.

Sketch. BINS coordinates are filled in rounds: round i < BINS throws every shingle into a hashed
bin, round BINS + i puts all of them into bin i, so every coordinate is filled; a coordinate keeps
the smallest (round, hash). The share of equal coordinates of two sketches estimates the Jaccard
similarity with Chernoff-type bounds. At 0.75, a pair is missed by all BANDS bands of ROWS
coordinates with probability (1 - 0.75**ROWS)**BANDS, below 3e-7.

Candidates. Pairing all members of a band group would be quadratic in its size. First each member
is compared with the smallest of its group only, and verified links are joined to components. Then
only members of different components of one group still matter: small groups give their pairs
across components; larger groups are cut into blocks, and each pair of blocks is compared in one task
that gives out verified links only. There a pair is looked at in one of its groups alone, and
exactly if its sketches agree in LEAST_AGREED coordinates, which a link misses with probability 1e-8.

Edge cases: a null or empty text has an empty set and is linked with nothing. A row without a
doc_id is linked with nothing, its component_id is null and it is kept. Rows that share an id are one document:
each of its texts is sketched and verified by its own set, and what any of them is linked with is in its component.
Texts of any length are read whole; extra columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import identified, stored
from issuelens.llm.graph import components
from issuelens.llm.hashing import Spans, column_bytes, mix

WORDS = 5
ROWS = 5
BANDS = 56
BINS = ROWS * BANDS
# Similarity as a fraction: links have DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 75, 100
# Up to so many members a band group gives its pairs directly.
SMALL_GROUP = 16
# Members of a block of a larger group, and agreeing coordinates (of BINS) below which a pair is no link.
BLOCK = 512
LEAST_AGREED = int(0.6 * BINS)
# Bytes of text handled at once.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

SKETCH = "doc long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary"
SKETCH_ARROW = pa.schema(
    [("doc", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
)


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about CHUNK bytes, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield row, min(stop, n)
        row = stop


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and 64-bit hashes of the distinct shingles of each text, sorted by row and hash."""
    text = _LOWER[data]
    space = _SPACE[text]
    border = np.zeros(len(text) + 1, dtype=bool)
    border[offsets] = True
    begin = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | border[:-1]))
    end = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | border[1:])) + 1
    if not len(begin):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    row = np.searchsorted(offsets, begin, side="right") - 1
    words = mix(Spans(text).raw(begin, end) + (end - begin).astype(np.uint64), 11)
    first = np.searchsorted(row, row, side="left")
    count = np.searchsorted(row, row, side="right") - first
    here = np.arange(len(row)) - first
    # A shingle starts at each word with four more after it, or at the first word of a shorter text.
    at = np.flatnonzero((here + WORDS <= count) | ((here == 0) & (count < WORDS)))
    span = np.minimum(count[at], WORDS)
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(WORDS):
        more = span > k
        value = np.where(more, mix(value ^ words[np.minimum(at + k, len(words) - 1)], 13), value)
    row = row[at]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))
    return row[new], value[new]


def sketches(row: np.ndarray, value: np.ndarray, n_rows: int) -> np.ndarray:
    """One sketch of BINS coordinates for each row; rows without shingles keep the largest value."""
    empty = np.uint64(2**64 - 1)
    sketch = np.full(n_rows * BINS, empty, dtype=np.uint64)
    shift = np.uint64(10)
    for i in range(2 * BINS):
        if not len(row):
            break
        drawn = mix(value, 100 + i)
        if i < BINS:
            bin_ = (drawn >> np.uint64(40)) % np.uint64(BINS)
        else:
            bin_ = np.full(len(row), i - BINS, dtype=np.uint64)
        at = row * BINS + bin_.astype(np.int64)
        free = sketch[at] == empty
        ranked = (np.uint64(i) << (np.uint64(64) - shift)) | (mix(drawn, 3) >> shift)
        np.minimum.at(sketch, at[free], ranked[free])
        if i >= 3 or i == 1:
            full = (sketch.reshape(n_rows, BINS) != empty).all(axis=1)
            going = ~full[row]
            row, value = row[going], value[going]
    return sketch.reshape(n_rows, BINS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sketch), BANDS), dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys ^ sketch[:, k::ROWS], 17)
    return mix(keys + np.arange(BANDS, dtype=np.uint64), 19)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc_id")
        data, offsets = column_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            own = offsets[a : b + 1]
            row, value = shingle_sets(data[own[0] : own[-1]], own - own[0])
            n = np.bincount(row, minlength=b - a)
            f1, f2 = np.zeros(b - a, dtype=np.uint64), np.zeros(b - a, dtype=np.uint64)
            filled = np.flatnonzero(n)
            if len(filled):
                starts = np.concatenate(([0], np.cumsum(n[filled])[:-1]))
                f1[filled] = np.add.reduceat(mix(value, 23), starts)
                f2[filled] = np.bitwise_xor.reduceat(mix(value, 29), starts)
            sketch = sketches(row, value, b - a)
            keys = band_keys(sketch).view(np.int64)
            # One byte of each coordinate is enough to estimate.
            short = [line.tobytes() for line in sketch.astype(np.uint8)]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [doc.slice(a, b - a).cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), bands, pa.array(short, pa.binary())],
                schema=SKETCH_ARROW,
            )


def _set_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[1]


def _similar(left: np.ndarray, right: np.ndarray) -> bool:
    if not len(left) or not len(right):
        return False
    places = np.minimum(np.searchsorted(left, right), len(left) - 1)
    shared = int((left[places] == right).sum())
    return DENOMINATOR * shared >= NUMERATOR * (len(left) + len(right) - shared)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs sorted by a: those whose sets are similar enough."""
    known = None
    for batch in batches:
        ids_a, ids_b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        keep = np.zeros(batch.num_rows, dtype=bool)
        texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
        for k in range(batch.num_rows):
            if known is None or known[0] != ids_a[k]:
                known = (ids_a[k], _set_of(texts_a[k].as_py()))
            keep[k] = _similar(known[1], _set_of(texts_b[k].as_py()))
        at = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(ids_a[at]), pa.array(ids_b[at])], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts, by `texts` (doc, text), are similar enough."""
    with_b = pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").sortWithinPartitions("a").mapInArrow(_verify, "a long, b long")


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Links across components among the members of one or two blocks of a band group."""
    table = table.combine_chunks()
    key, low, high = table.column("key")[0].as_py(), table.column("low")[0].as_py(), table.column("high")[0].as_py()
    doc, component, block, n = (table.column(c).to_numpy() for c in ("doc", "component", "block", "n_shingles"))
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, BINS)
    texts, sets, found = table.column("text"), {}, []

    def shingles_of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = _set_of(texts[i].as_py())
        return sets[i]

    right = np.flatnonzero(block == high)
    for i in np.flatnonzero(block == low):
        others = right[(component[right] != component[i]) & ((doc[right] > doc[i]) | (low != high))]
        least, most = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        others = others[DENOMINATOR * least >= NUMERATOR * most]
        others = others[(sketch[others] == sketch[i]).sum(axis=1) >= LEAST_AGREED]
        # Each pair is compared in the group of its smallest shared key alone.
        smallest = np.where(bands[others] == bands[i], bands[others], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        for j in others[smallest == key]:
            if _similar(shingles_of(i), shingles_of(j)):
                found.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.table([pairs[:, 0], pairs[:, 1]], names=["a", "b"])


def _pairs_across(groups: DataFrame, key: str) -> DataFrame:
    """Distinct pairs a < b of rows (key, doc, component) with one key and different components."""
    left = groups.select(key, F.col("doc").alias("a"), F.col("component").alias("ca"))
    right = groups.select(key, F.col("doc").alias("b"), F.col("component").alias("cb"))
    return left.join(right, key).where("a < b AND ca <> cb").select("a", "b").distinct()


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, doc, component) of the keys with more than one component, with the number of members."""
    groups = rows.groupBy(key).agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("members")
    )
    return rows.join(groups.where("least < most").select(key, "members"), key)


def block_links(crowd: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) across components within the groups of `crowd` (key, doc, component, members)."""
    count = F.ceil(F.col("members") / BLOCK)
    rows = crowd.withColumn("block", F.pmod(F.xxhash64("doc"), count)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    )
    rows = rows.select(
        "key", "doc", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    facts = classes.select(F.col("rep").alias("doc"), "n_shingles", "bands", "sketch").join(texts, "doc")
    return rows.join(facts, "doc").groupBy("key", "low", "high").applyInArrow(_compare_blocks, "a long, b long").distinct()


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row of `docs`, whose ids have one text each, (doc, n_shingles, rep), and all links (a, b) between representatives of different sets.

    Pairs that are already in one component are not compared further, so `links` holds enough links
    to join everything that is similar; `rep` is the smallest id with the same set.
    """
    rows = stored(docs.select("doc_id", "text").mapInArrow(_sketch, SKETCH), "sketches")
    filled = rows.where("n_shingles > 0 AND doc IS NOT NULL")
    classes = stored(
        filled.groupBy("f1", "f2", "n_shingles").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes"
    )
    members = rows.drop("bands", "sketch").join(classes.drop("bands", "sketch"), ["f1", "f2", "n_shingles"], "left")
    banded = classes.select(F.col("rep").alias("doc"), F.explode("bands").alias("key"))
    groups = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc").alias("pivot")).where("members > 1")
    grouped = stored(banded.join(groups, "key"), "groups")
    wanted = grouped.select("doc").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc IS NOT NULL AND text IS NOT NULL")
    # An id has one text here; equal rows give it once.
    texts = stored(texts.join(wanted, "doc", "left_semi"), "texts")
    if texts.groupBy("doc").count().where("count > 1").limit(1).count():
        texts = texts.groupBy("doc").agg(F.max("text").alias("text"))
    star = grouped.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    links = stored(verified(star, texts), "links")
    labels = components(links)
    labelled = grouped.join(labels, grouped.doc == labels.node, "left")
    labelled = labelled.select("key", "doc", F.coalesce("component", "doc").alias("component"))
    open_groups = stored(_mixed(labelled, "key"), "open")
    pairs = _pairs_across(open_groups.where(F.col("members") <= SMALL_GROUP), "key")
    more = verified(pairs.join(star, ["a", "b"], "left_anti"), texts)
    crowd = open_groups.where(F.col("members") > SMALL_GROUP)
    more = stored(more.unionByName(block_links(crowd, classes, texts)), "links")
    return members.select("doc", "n_shingles", "rep"), links.unionByName(more)


def _labelled(docs: DataFrame) -> DataFrame:
    """doc, n_shingles and label (the smallest id of the component) of each row of `docs` (doc_id, text)."""
    members, links = near_links(docs)
    labels = components(links)
    rows = members.join(labels, members.rep == labels.node, "left")
    return rows.select("doc", "n_shingles", F.coalesce("component", "rep", "doc").alias("label"))


def _labelled_by_text(rows: DataFrame) -> DataFrame:
    """The same for rows (doc_id, tie, text) of which some share an id: each text of an id is a node of its own, all
    nodes of an id are linked, and components take their smallest doc_id."""
    node = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "tie"))
    named = rows.withColumn("node", node)
    members, links = near_links(named.select(F.col("node").alias("doc_id"), "text"))
    names = stored(named.where("node IS NOT NULL").select(F.col("node").alias("doc"), F.col("doc_id").cast("long").alias("id")).distinct(), "names")
    first = names.groupBy("id").agg(F.min("doc").alias("a"))
    same_id = names.join(first, "id").select("a", F.col("doc").alias("b"))
    same_set = members.where("rep IS NOT NULL").select(F.col("rep").alias("a"), F.col("doc").alias("b")).distinct()
    labels = components(links.unionByName(same_id).unionByName(same_set))
    of_node = names.join(labels, names.doc == labels.node, "left").select("doc", "id", F.coalesce("component", "doc").alias("component"))
    least = of_node.groupBy("component").agg(F.min("id").alias("label"))
    of_node = of_node.join(least, "component").drop("component")
    return members.join(of_node, "doc", "left").select(F.col("id").alias("doc"), "n_shingles", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept, one row per row of `docs`."""
    named, unique = identified(docs)
    rows = _labelled(docs) if unique else _labelled_by_text(named)
    return rows.select(
        F.col("doc").alias("doc_id"),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), F.col("label")).alias("component_id"),
        F.coalesce(F.col("doc") == F.col("label"), F.lit(True)).alias("kept"),
    )
