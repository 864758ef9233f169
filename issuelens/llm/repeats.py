"""Exact repeats of at least MIN_LENGTH bytes across a corpus, by a distributed enhanced suffix array.

A suffix array over all bytes of a corpus has one entry per byte. Here the text is first cut so that
only parts that can repeat reach it, without losing one:

1. Anchors. Each window of MIN_LENGTH bytes picks its smallest hashed GRAM-byte string. Consecutive
   windows with one pick form a segment, so every window lies in exactly one segment and equal
   windows have equal anchors. Segments go by anchor to the tasks; equal segments (anchor and
   content) are one class of copies, of which only the first goes on. Copies within a batch do not
   take part in that: they go, with the name of their class, to any task.
2. Suffix array. First segments whose anchor has different contents are fetched as bytes and sorted
   by suffix, block by block of whole anchors. The common-prefix intervals are found with a stack
   over the neighbours' common prefix lengths; an interval whose left neighbours differ is a
   maximal repeat. For removal each such interval names only the first places of its children except its own
   first, so a place is named once however deep it lies; `groups` lists every interval with all its places.
3. An anchor with more than HOT_ANCHOR contents would make a block unbounded. Each of its windows
   goes with the rest of its segment to a bucket of equal windows, and the buckets through step 2: a
   repeat of MIN_LENGTH bytes lies in one bucket, which has at most one row per content.
4. Groups. Each occurrence in a first segment stands for one in every copy of that segment. A class
   of copies that step 2 did not give as a whole is a group of its own, as no other segment holds it.

A repeat longer than a segment appears as a chain of overlapping groups; their union covers it.
Order is (doc_id, start), rows without a doc_id first; rows that share a doc_id are ordered by a hash
of their text, and equal rows count once. Null texts are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import identified, stored
from issuelens.llm.hashing import Spans, column_bytes, mix

MIN_LENGTH = 100
GRAM = 32
PICKS = MIN_LENGTH - GRAM + 1
# Windows handled at once; longer texts are cut between windows.
CHUNK = 1 << 19
HOT_ANCHOR = 2000
BLOCK = 2000
# Copies of one class that go together in the join of groups and copies.
HOT_COPIES = 2000
NO_ID = -(2**63)

SEGMENT = "kind int, anchor long, content long, doc long, tie long, start long, n int"
SEGMENT_ARROW = pa.schema(
    [("kind", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("n", pa.int32())]
)
# SPAN: n bytes that also start earlier, joined copies of one batch. The others are segments of n windows.
# COPY: copy of an earlier one in its batch; its bytes are in a SPAN too. FIRST: first of its class in the batch,
# later on first of all in an anchor with several contents. HEAD: the same with copies, later on first of all with
# copies anywhere. LATER: copy of one in another batch.
SPAN, COPY, FIRST, HEAD, LATER = range(5)
GROUP = "repeat long, length int, anchor long, content long, inner int, doc long, tie long, start long, first boolean, whole boolean"
GROUP_ARROW = pa.schema(
    [("repeat", pa.int64()), ("length", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64()), ("inner", pa.int32()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("first", pa.bool_()), ("whole", pa.bool_())]
)

# n bytes from `start` on that also start earlier.
PLACED = "doc long, tie long, start long, n int"
PLACED_ARROW = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])

# REPEAT: a maximal repeat and the longest other one that it begins with. PLACE: the longest repeat that begins `inner`
# bytes into the segments of one class. COPY_OF: where a segment of a class begins.
REPEAT, PLACE, COPY_OF = range(3)
TREE = "kind int, repeat long, length int, parent long, anchor long, content long, inner int, whole boolean"
TREE_ARROW = pa.schema(
    [("kind", pa.int32()), ("repeat", pa.int64()), ("length", pa.int32()), ("parent", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64()), ("inner", pa.int32()), ("whole", pa.bool_())]
)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    done, span = values, 1
    while 2 * span <= width:
        done = np.minimum(done[:-span], done[span:])
        span *= 2
    return np.minimum(done[: len(values) - width + 1], done[width - span : len(values) - span + 1])


def pieces(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of (row, first byte, last byte + 1) of about CHUNK bytes; a long text gives several pieces that share no window."""
    rows, firsts, lasts, size = [], [], [], 0
    for row in np.flatnonzero(np.diff(offsets) >= MIN_LENGTH):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at >= MIN_LENGTH:
            stop = min(end, at + CHUNK + MIN_LENGTH - 1)
            rows.append(row), firsts.append(at), lasts.append(stop)
            size += stop - at
            at = stop - MIN_LENGTH + 1
            if size >= CHUNK:
                yield np.array(rows), np.array(firsts), np.array(lasts)
                rows, firsts, lasts, size = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(firsts), np.array(lasts)


def segments_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start in the row, number of windows, anchor hash and content hash of all segments, in order of row and start."""
    found = []
    for rows, firsts, lasts in pieces(offsets):
        sizes = lasts - firsts
        begins = np.concatenate(([0], np.cumsum(sizes)))
        text = np.concatenate([data[a:b] for a, b in zip(firsts, lasts)])
        spans = Spans(text)
        grams = spans.every(GRAM)
        low = np.uint64((1 << 21) - 1)
        keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        picked = (sliding_min(keyed, PICKS) & low).astype(np.int64)
        # Windows that lie inside one piece; the pick changes at each border of a piece.
        inside = np.ones(len(picked), dtype=bool)
        for end in begins[1:-1]:
            inside[end - MIN_LENGTH + 1 : end] = False
        windows = np.flatnonzero(inside)
        picked = picked[windows]
        new = np.concatenate(([True], (picked[1:] != picked[:-1]) | (windows[1:] != windows[:-1] + 1)))
        at = np.flatnonzero(new)
        n = np.diff(np.concatenate((at, [len(windows)])))
        begin = windows[at]
        piece = np.searchsorted(begins, begin, side="right") - 1
        anchor = grams[picked[at]]
        content = mix(spans.raw(begin, begin + n + MIN_LENGTH - 1), 2)
        start = begin - begins[piece] + firsts[piece] - offsets[rows[piece]]
        place = picked[at] - begins[piece] + firsts[piece]
        found.append((rows[piece], start, n, anchor, content, place))
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    row, start, n, anchor, content, place = (np.concatenate(part) for part in zip(*found))
    # A segment that the border of a piece has cut is joined again, as its copies elsewhere are whole.
    at = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1]))))
    cut_up = np.flatnonzero(np.diff(np.concatenate((at, [len(row)]))) > 1)
    n = np.add.reduceat(n, at)
    row, start, anchor, content = row[at], start[at], anchor[at], content[at]
    for k in cut_up.tolist():
        begin = int(offsets[row[k]] + start[k])
        size = int(n[k]) + MIN_LENGTH - 1
        content[k] = mix(Spans(data[begin : begin + size]).raw(np.array([0]), np.array([size])), 2)[0]
    return row, start, n, anchor, content


def _copies(anchor: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the anchor and content of an earlier row, and which are the first of several such rows."""
    key = anchor * np.uint64(0x9FB21C651E98DF25) + content
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    first = first[back]
    later = (first != np.arange(len(key))) & (anchor[first] == anchor) & (content[first] == content)
    copied = np.zeros(len(key), dtype=bool)
    copied[first[later]] = True
    return later, copied


def _joined_spans(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans ordered by (doc, tie, start), touching or overlapping ones of a document joined."""
    if not len(doc):
        return doc, tie, start, end
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > end[:-1])))
    at = np.flatnonzero(new)
    return doc[at], tie[at], start[at], np.maximum.reduceat(end, at)


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        order = np.lexsort((batch.column("tie").to_numpy(), batch.column("doc").to_numpy()))
        batch = batch.take(pa.array(order))
        doc, tie = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
        data, offsets = column_bytes(batch.column("text"))
        row, start, n, anchor, content = segments_of(data, offsets)
        doc, tie = doc[row], tie[row]
        later, copied = _copies(anchor, content)
        span = _joined_spans(doc[later], tie[later], start[later], (start + n + MIN_LENGTH - 1)[later])
        none = np.zeros(len(span[0]), dtype=np.uint64)
        kind = np.where(later, COPY, np.where(copied, HEAD, FIRST))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((kind, np.full(len(none), SPAN))).astype(np.int32)),
                pa.array(np.concatenate((anchor, none)).view(np.int64)),
                pa.array(np.concatenate((content, none)).view(np.int64)),
                pa.array(np.concatenate((doc, span[0]))),
                pa.array(np.concatenate((tie, span[1]))),
                pa.array(np.concatenate((start, span[2]))),
                pa.array(np.concatenate((n, span[3] - span[2])).astype(np.int32)),
            ],
            schema=SEGMENT_ARROW,
        )


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows with SPAN and COPY last and the others sorted by (anchor, content, doc, tie, start): all kinds of rows.

    Holds two rows between batches, however many rows an anchor has.
    """
    # `held`: a first segment whose anchor has no other content so far; `lead`: the first segment of the last class.
    last = held = lead = None
    shared = headed = False
    for batch in batches:
        kinds = batch.column(0).to_numpy()
        ready = (kinds == SPAN) | (kinds == COPY)
        if ready.any():
            yield batch.filter(pa.array(ready))
            batch = batch.filter(pa.array(~ready))
        kinds, *columns = (batch.column(k).to_numpy() for k in range(7))
        anchor, content = columns[:2]
        if not len(anchor):
            continue
        before = (np.concatenate(([last[0] if last else ~anchor[0]], anchor[:-1])), np.concatenate(([last[1] if last else 0], content[:-1])))
        first = (anchor != before[0]) | (content != before[1])
        at = np.flatnonzero(first)
        several = ~first | (kinds == HEAD)
        copied = np.logical_or.reduceat(several, at) if len(at) else np.zeros(0, dtype=bool)
        heads = [x[at[copied]] for x in columns]
        if not first[0] and not headed:
            heads = [np.concatenate(([h], r)) for h, r in zip(lead, heads)]
        lead, headed = ([x[at[-1]] for x in columns], copied[-1]) if len(at) else (lead, True)
        rows = [x[at] for x in columns]
        if held is not None:
            rows = [np.concatenate(([h], r)) for h, r in zip(held, rows)]
        keep = np.zeros(len(rows[0]), dtype=bool)
        if len(rows[0]):
            equal = rows[0][1:] == rows[0][:-1]
            keep[1:] |= equal
            keep[:-1] |= equal
            if shared and last is not None:
                keep |= rows[0] == last[0]
        last = (anchor[-1], content[-1])
        held, shared_next = None, False
        if len(rows[0]) and rows[0][-1] == last[0]:
            if keep[-1]:
                shared_next = True
            else:
                held = [r[-1] for r in rows]
        elif shared and at.size == 0 and anchor[0] == last[0]:
            shared_next = True
        shared = shared_next
        parts = [(LATER, [x[~first] for x in columns]), (HEAD, heads), (FIRST, [x[keep] for x in rows])]
        kind = np.concatenate([np.full(len(part[0]), k, dtype=np.int32) for k, part in parts])
        merged = [np.concatenate(column) for column in zip(*(part for _, part in parts))]
        merged[-1] = merged[-1].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, merged)], schema=SEGMENT_ARROW)


def classes_of(segments: DataFrame) -> DataFrame:
    """The rows of all kinds; FIRST and HEAD are now the first of all batches."""
    ready = F.col("kind").isin(SPAN, COPY)
    # Nothing is looked up for the ready ones: they are spread, also where one class has a large share of all rows.
    dealt = segments.repartition(F.when(ready, F.xxhash64("doc", "tie", "start")).otherwise(F.col("anchor")))
    return dealt.sortWithinPartitions(ready, "anchor", "content", "doc", "tie", "start").mapInArrow(_classes, SEGMENT)


def lcp_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix length, first, last) of each interval of a suffix array, by a stack.

    lcp[i] is the common prefix length of suffixes i - 1 and i; lcp[0] is 0.
    """
    stack = [(0, 0)]
    for i, here in enumerate([*lcp[1:], 0], start=1):
        first = i - 1
        while stack[-1][0] > here:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if stack[-1][0] < here:
            stack.append((here, first))


class Suffixes(NamedTuple):
    """The enhanced suffix array of the windows of some segments: `order` has the suffixes' numbers (by segment and
    start) from the smallest suffix on, `owner` and `inner` the segment and place of each number, `lcp` the common
    prefix of each suffix with the one before it. `changes` counts where the byte before a suffix differs from that
    before its neighbour, so a range with one value throughout can be extended to the left in all its places. `parts` are
    the ranges whose suffixes share MIN_LENGTH bytes with a neighbour and that cannot be extended as a whole."""

    order: np.ndarray
    owner: np.ndarray
    inner: np.ndarray
    lcp: np.ndarray
    changes: np.ndarray
    parts: list[tuple[int, int]]


def suffixes_of(data: np.ndarray, offsets: np.ndarray, n: np.ndarray, before: np.ndarray | None = None) -> Suffixes:
    """`before` has the byte before each segment, -1 where it is unknown."""
    owner = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place = offsets[owner] + inner
    length = offsets[owner + 1] - place
    width = int(length.max(initial=MIN_LENGTH))
    padded = np.concatenate((data, np.zeros(width, dtype=np.uint8)))
    suffixes = np.lib.stride_tricks.sliding_window_view(padded, width)[place]
    suffixes[np.arange(width) >= length[:, None]] = 0
    order = np.argsort(suffixes.view(f"S{width}").ravel(), kind="stable")
    suffixes, size = suffixes[order], length[order]
    differ = suffixes[1:] != suffixes[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.concatenate(([0], np.minimum(common, np.minimum(size[1:], size[:-1]))))
    # The byte before each suffix; an unknown one counts as unlike any other.
    outer = np.full(len(n), -1) if before is None else before
    left = np.where(inner[order] > 0, padded[place[order] - 1].astype(np.int64), outer[owner[order]])
    left = np.where(left < 0, -1 - np.arange(len(order)), left)
    changes = np.concatenate(([0], np.cumsum(left[1:] != left[:-1])))
    near = lcp >= MIN_LENGTH
    begins = np.flatnonzero(near & ~np.concatenate(([False], near[:-1]))) - 1
    ends = np.flatnonzero(near & ~np.concatenate((near[1:], [False])))
    varied = changes[ends] > changes[begins]
    return Suffixes(order, owner, inner, lcp, changes, list(zip(begins[varied].tolist(), ends[varied].tolist())))


def maximal_repeats(data: np.ndarray, offsets: np.ndarray, n: np.ndarray, before: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, segments, starts) of every string of MIN_LENGTH bytes or more that occurs twice or more
    in the given segments, starts in one of their windows, and can be extended neither way in all its places.

    Occurrences come in order of segment and start.
    """
    order, owner, inner, lcp, changes, parts = suffixes_of(data, offsets, n, before)
    for a, b in parts:
        for depth, first, last in lcp_intervals([0, *lcp[a + 1 : b + 1].tolist()]):
            if depth >= MIN_LENGTH and changes[a + last] > changes[a + first]:
                at = np.sort(order[a + first : a + last + 1])
                yield depth, owner[at], inner[at]


def later_places(order: list[int], lcp: list[int], changes: list[int]) -> Iterator[tuple[int, int]]:
    """(suffix number, length) of the longest maximal repeat that a suffix has in common with a smaller number, for each
    suffix that has one: a stack-scan of the interval tree in which each maximal interval names the first suffixes of
    its children except its own first. That is one at most for each suffix, however deep the tree is.

    A place whose longest such string can be extended to the left is left out: the place before it has the longer one.
    """
    # Of each open interval: depth, first place in the order, first suffixes of its children so far.
    stack = [(0, 0, [])]
    for i, here in enumerate([*lcp[1:], 0]):
        if here > stack[-1][0]:
            stack.append((here, i, [order[i]]))
            continue
        stack[-1][2].append(order[i])
        while stack[-1][0] > here:
            depth, begin, firsts = stack.pop()
            first = min(firsts)
            if depth >= MIN_LENGTH and changes[i] > changes[begin]:
                yield from ((f, depth) for f in firsts if f != first)
            if stack[-1][0] < here:
                stack.append((here, begin, [first]))
            else:
                stack[-1][2].append(first)


def repeat_tree(order: list[int], lcp: list[int], changes: list[int]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """The tree of maximal repeats of a range of suffixes: (length, first suffix number, parent or -1) of each, and
    (suffix number, longest maximal repeat that begins there) for each suffix that has one.

    All places of a repeat are those given for it and for the repeats below it.
    """
    nodes, places = [], []
    # Of each open interval: length, first place in the order, smallest suffix, and what is still without a maximal
    # repeat: suffix numbers, repeats k as ~k, and lists of them.
    stack = [(0, 0, len(order) and max(order), [])]

    def close(i: int) -> tuple[int, int, int | list]:
        depth, begin, first, held = stack.pop()
        if changes[i] == changes[begin]:
            return begin, first, held
        nodes.append([depth, first, -1])
        while held:
            entry = held.pop()
            if isinstance(entry, list):
                held.extend(entry)
            elif entry < 0:
                nodes[~entry][2] = len(nodes) - 1
            else:
                places.append((entry, len(nodes) - 1))
        return begin, first, ~(len(nodes) - 1)

    def add(first: int, entry: int | list) -> None:
        depth, begin, known, held = stack[-1]
        held.append(entry)
        stack[-1] = (depth, begin, min(known, first), held)

    for i, here in enumerate([*lcp[1:], 0]):
        if here > stack[-1][0]:
            stack.append((here, i, order[i], [order[i]]))
            continue
        add(order[i], order[i])
        while stack[-1][0] > here:
            begin, first, entry = close(i)
            if stack[-1][0] < here:
                stack.append((here, begin, first, [entry]))
            else:
                add(first, entry)
    return nodes, places


def _spans_of_block(table: pa.Table) -> pa.RecordBatch:
    data, offsets = column_bytes(table.column("bytes").combine_chunks())
    doc, tie, start, n, before = (table.column(c).to_numpy() for c in ("doc", "tie", "start", "n", "before"))
    order, owner, inner, lcp, changes, parts = suffixes_of(data, offsets, n.astype(np.int64), before)
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for a, b in parts:
        part = slice(a, b + 1)
        pairs = list(later_places(order[part].tolist(), [0, *lcp[a + 1 : b + 1].tolist()], changes[part].tolist()))
        found.append(tuple(np.array(x, dtype=np.int64) for x in zip(*pairs)) if pairs else found[0])
    at, length = map(np.concatenate, zip(*found))
    by_place = np.argsort(at)
    at, length = at[by_place], length[by_place]
    of, begin = owner[at], inner[at]
    # Spans of one segment that touch or overlap are joined.
    of, _, begin, end = _joined_spans(of, np.zeros(len(of), dtype=np.int64), begin, begin + length)
    columns = [doc[of], tie[of], start[of] + begin, (end - begin).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PLACED_ARROW)], schema=PLACED_ARROW)


def _groups_of_block(table: pa.Table) -> pa.RecordBatch:
    data, offsets = column_bytes(table.column("bytes").combine_chunks())
    anchor, content, base, doc, tie, start, n, before = (
        table.column(c).to_numpy() for c in ("anchor", "content", "inner", "doc", "tie", "start", "n", "before")
    )
    spans, sizes = Spans(data), np.diff(offsets)
    at, length, owners, starts, first = [], [], [], [], []
    for depth, owner, inner in maximal_repeats(data, offsets, n.astype(np.int64), before):
        at.append(np.full(len(owner), offsets[owner[0]] + inner[0]))
        length.append(np.full(len(owner), depth, dtype=np.int32))
        owners.append(owner), starts.append(inner)
        first.append(np.arange(len(owner)) == 0)
    if not at:
        return pa.RecordBatch.from_pylist([], schema=GROUP_ARROW)
    at, length, owners, starts, first = map(np.concatenate, (at, length, owners, starts, first))
    # The name of a group is the content hash of its bytes, as for classes.
    repeat = mix(spans.raw(at, at + length), 2).view(np.int64)
    inner = (base[owners] + starts).astype(np.int32)
    whole = (inner == 0) & (length == sizes[owners])
    columns = [repeat, length, anchor[owners], content[owners], inner, doc[owners], tie[owners], start[owners] + starts, first, whole]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=GROUP_ARROW)


def _tree_of_block(table: pa.Table) -> pa.RecordBatch:
    data, offsets = column_bytes(table.column("bytes").combine_chunks())
    anchor, content, base, n, before = (table.column(c).to_numpy() for c in ("anchor", "content", "inner", "n", "before"))
    order, owner, inner, lcp, changes, parts = suffixes_of(data, offsets, n.astype(np.int64), before)
    nodes, places = [np.zeros((0, 3), dtype=np.int64)], [np.zeros((0, 2), dtype=np.int64)]
    known = 0
    for a, b in parts:
        here, at = repeat_tree(order[a : b + 1].tolist(), [0, *lcp[a + 1 : b + 1].tolist()], changes[a : b + 1].tolist())
        # A range without MIN_LENGTH in common ends the tree: its root is no repeat.
        shift = lambda k: np.where(k < 0, k, k + known)
        if here:
            here, at = np.array(here), np.array(at).reshape(-1, 2)
            here[:, 2], at[:, 1] = shift(here[:, 2]), shift(at[:, 1])
            nodes.append(here), places.append(at)
            known += len(here)
    nodes, places = np.concatenate(nodes), np.concatenate(places)
    spans, sizes = Spans(data), np.diff(offsets)
    length, first, parent = nodes.T
    at = offsets[owner[first]] + inner[first]
    # The name of a repeat is the content hash of its bytes, as for classes.
    name = mix(spans.raw(at, at + length), 2).view(np.int64)
    number, of = places.T
    suffix, node = np.concatenate((first, number)), np.concatenate((np.arange(len(nodes)), of))
    is_node = np.arange(len(suffix)) < len(nodes)
    segment, begin = owner[suffix], base[owner[suffix]] + inner[suffix]
    columns = [
        pa.array(np.where(is_node, REPEAT, PLACE).astype(np.int32)), pa.array(name[node]), pa.array(length[node].astype(np.int32)),
        pa.array(name[parent[node]] if len(nodes) else name, mask=~is_node | (parent[node] < 0)),
        pa.array(anchor[segment]), pa.array(content[segment]), pa.array(begin.astype(np.int32)),
        pa.array((begin == 0) & (length[node] == sizes[segment])),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=TREE_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch], of_block: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `of_block` makes of blocks of whole buckets, from rows sorted by (bucket, doc, tie, start)."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        bucket = rest.column("bucket").to_numpy()
        borders = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
        done = 0
        while len(borders) and len(bucket) - done >= BLOCK:
            inside = borders[(borders > done) & (borders <= done + BLOCK)]
            after = borders[borders > done]
            if not len(after):
                break
            stop = int(inside[-1] if len(inside) else after[0])
            yield of_block(rest.slice(done, stop - done))
            done = stop
        rest = rest.slice(done)
    if rest is not None and rest.num_rows:
        yield of_block(rest)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _blocks(batches, _groups_of_block)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _blocks(batches, _tree_of_block)


def _later_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _blocks(batches, _spans_of_block)


FETCHED = "bucket long, anchor long, content long, inner int, doc long, tie long, start long, n int, before int, bytes binary"
FETCHED_ARROW = pa.schema(
    [("bucket", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64()), ("inner", pa.int32()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("before", pa.int32()), ("bytes", pa.binary())]
)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments of each text; where the anchor is hot, bytes from each window on and the byte before it."""
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        wanted = batch.column("wanted")
        counts = np.diff(wanted.offsets.to_numpy())
        flat = wanted.flatten()
        row = np.repeat(np.arange(batch.num_rows), counts)
        anchor, content, start, n, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(5))
        doc, tie = batch.column("doc").to_numpy()[row], batch.column("tie").to_numpy()[row]
        begin = offsets[row] + start
        raw = data.tobytes()

        def rows(at, bucket, inner, windows, before):
            places = zip((begin[at] + inner).tolist(), (begin[at] + n[at] + MIN_LENGTH - 1).tolist())
            fields = [bucket, anchor[at], content[at], inner.astype(np.int32), doc[at], tie[at], start[at] + inner, windows.astype(np.int32), before.astype(np.int32)]
            return pa.RecordBatch.from_arrays([*map(pa.array, fields), pa.array([raw[a:b] for a, b in places], pa.binary())], schema=FETCHED_ARROW)

        cold = np.flatnonzero(~hot)
        yield rows(cold, anchor[cold], np.zeros(len(cold), dtype=np.int64), n[cold], np.full(len(cold), -1))
        hot = np.flatnonzero(hot)
        for k in range(0, len(hot), 2000):
            at = hot[k : k + 2000]
            text = np.concatenate([data[b : b + m + MIN_LENGTH - 1] for b, m in zip(begin[at].tolist(), n[at].tolist())])
            m = n[at].astype(np.int64)
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            where = inner + np.repeat(np.cumsum(m + MIN_LENGTH - 1) - (m + MIN_LENGTH - 1), m)
            bucket = mix(Spans(text).raw(where, where + MIN_LENGTH), 5).view(np.int64)
            before = np.where(inner > 0, text[where - 1].astype(np.int64), -1)
            yield rows(np.repeat(at, m), bucket, inner, np.ones(len(where)), before)


class Repeats:
    """What is repeated in `docs`: `spans` (doc, tie, start, n) that also start earlier, and `groups`."""

    def __init__(self, docs: DataFrame, *carry: str):
        rows, unique = identified(docs, *carry)
        self.texts = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), "tie", "text", *carry)
        once = self.texts.select("doc", "tie", "text")
        once = once if unique else once.dropDuplicates(["doc", "tie"])
        segments = once.where(F.octet_length("text") >= MIN_LENGTH).mapInArrow(_segment_batches, SEGMENT)
        self.found = stored(classes_of(segments), "segments")
        # With the columns that come along, so that the joins with segments and with spans read one shuffle of the texts.
        self._once = self.texts if unique else once

    @property
    def _fetched(self) -> DataFrame:
        """First segments of anchors with several contents as bytes, each bucket in one task and in order."""
        firsts = self.found.where(F.col("kind") == FIRST)
        crowded = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > HOT_ANCHOR)
        # At most one anchor per HOT_ANCHOR first segments; one with a large share of them is not dealt by its anchor.
        firsts = firsts.join(F.broadcast(crowded), "anchor", "left").withColumn("hot", F.col("many").isNotNull())
        wanted = firsts.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "content", "start", "n", "hot")).alias("wanted"))
        fetched = self._once.join(wanted, ["doc", "tie"]).mapInArrow(_fetch, FETCHED)
        return fetched.repartition("bucket").sortWithinPartitions("bucket", "doc", "tie", "start")

    @cached_property
    def tree(self) -> DataFrame:
        """Repeats among first segments with all their places there."""
        return stored(self._fetched.mapInArrow(_groups, GROUP), "groups")

    @cached_property
    def factored(self) -> DataFrame:
        """All repeats and all their places in a size that grows with the number of segments and no faster.

        Rows of three kinds: REPEAT (repeat, length, parent), PLACE (repeat, length, and the class anchor and content with
        `inner`) and COPY_OF (anchor, content, doc, tie, start). The places of a repeat are the PLACE rows of it and of all
        repeats below it, each in every copy of its class.
        """
        tree = stored(self._fetched.mapInArrow(_trees, TREE), "tree")
        content = ["anchor", "content"]
        own = self.found.where(F.col("kind") == HEAD).join(tree.where("whole").select(*content).distinct(), content, "left_anti")
        # A class of copies that no other segment holds as a whole is a repeat of its own.
        own = own.select(
            F.explode(F.array(F.lit(REPEAT), F.lit(PLACE))).alias("kind"), F.col("content").alias("repeat"),
            (F.col("n") + (MIN_LENGTH - 1)).alias("length"), *content, F.lit(0).alias("inner"),
        )
        listed = tree.drop("whole").unionByName(own.withColumn("parent", F.lit(None).cast("long")))
        segments = self.found.where(F.col("kind") != SPAN).select("kind", *content, "doc", "tie", "start")
        firsts = segments.where(F.col("kind") == FIRST).join(tree.where(F.col("kind") == PLACE).select(*content).distinct(), content, "left_semi")
        # A class that has copies and stands in the tree is in `found` as FIRST and as HEAD.
        heads = segments.where(F.col("kind") == HEAD).unionByName(firsts).dropDuplicates([*content, "doc", "tie", "start"])
        copies = heads.unionByName(segments.where(F.col("kind").isin(COPY, LATER))).withColumn("kind", F.lit(COPY_OF))
        return listed.unionByName(copies, allowMissingColumns=True)

    @cached_property
    def spans(self) -> DataFrame:
        """doc, tie, start, n: bytes that also start earlier; one row or a few for each segment."""
        spans = [
            self.found.where(F.col("kind") == SPAN).select("doc", "tie", "start", "n"),
            self.found.where(F.col("kind") == LATER).select("doc", "tie", "start", (F.col("n") + (MIN_LENGTH - 1)).alias("n")),
            self._fetched.mapInArrow(_later_spans, PLACED),
        ]
        return spans[0].unionByName(spans[1]).unionByName(spans[2])

    @property
    def groups(self) -> DataFrame:
        """Each repeat with all its occurrences in the corpus: repeat, length, doc, tie, start, first.

        A class with more than HOT_COPIES copies is joined in parts of about that many.
        """
        content = ["anchor", "content"]
        heads = self.found.where(F.col("kind") == HEAD).join(self.tree.where("whole").select(*content).distinct(), content, "left_anti")
        heads = heads.select(
            F.col("content").alias("repeat"), (F.col("n") + (MIN_LENGTH - 1)).alias("length"), *content,
            F.lit(0).alias("inner"), "doc", "tie", "start", F.lit(True).alias("first"),
        )
        listed = self.tree.drop("whole").unionByName(heads)
        copies = self.found.where(F.col("kind").isin(COPY, LATER)).select(*content, "doc", "tie", "start")
        # At most one row per HOT_COPIES copies.
        crowded = copies.groupBy(*content).agg(F.ceil(F.count(F.lit(1)) / HOT_COPIES).alias("parts")).where(F.col("parts") > 1)
        crowded = F.broadcast(stored(crowded, "crowded"))
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        copies = copies.join(crowded, content, "left").withColumn("part", F.pmod(F.xxhash64("doc", "tie", "start"), parts)).drop("parts")
        wanted = listed.select("repeat", "length", *content, "inner").join(crowded, content, "left")
        wanted = wanted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
        more = copies.join(wanted, [*content, "part"]).select(
            "repeat", "length", "doc", "tie", (F.col("start") + F.col("inner")).alias("start"), F.lit(False).alias("first")
        )
        return listed.select("repeat", "length", "doc", "tie", "start", "first").unionByName(more)


CUT = "doc long, tie long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string, kept_sha256 string"
CUT_ARROW = pa.schema(
    [("doc", pa.int64()), ("tie", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_text", pa.string()), ("kept_sha256", pa.string())]
)


def cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left of a text."""
    if not len(starts):
        return 0, 0, text
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    begins = starts[new].tolist()
    stops = ends[np.concatenate((new[1:] - 1, [len(ends) - 1]))].tolist()
    kept = b"".join(text[a:b] for a, b in zip([0, *stops], [*begins, len(text)]))
    return len(text) - len(kept), len(begins), kept


def remove_repeats(docs: DataFrame, with_bytes: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row's (doc, tie) with its size, what was removed, and the bytes that are left and their SHA-256.

    `kept_text` drops the bytes of a character that a cut left incomplete. `with_bytes` False leaves `kept` and
    `kept_text` null. Columns of `docs` named in `carry` come along as the struct `carried`.
    """
    repeats = Repeats(docs, *carry)
    span = F.struct("start", (F.col("start") + F.col("n")).alias("end"))
    pairs = repeats.spans.groupBy("doc", "tie").agg(F.collect_list(span).alias("spans"))

    def apply(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                raw = (text.as_py() or "").encode()
                values = spans.values
                if values is None or not len(values):
                    starts = ends = np.zeros(0, dtype=np.int64)
                else:
                    starts, ends = values.field(0).to_numpy(), values.field(1).to_numpy()
                removed, runs, kept = cut(raw, starts, ends)
                left = (kept, kept.decode("utf-8", "ignore")) if with_bytes else (None, None)
                rows.append((len(raw), removed, runs, *left, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 6
            values = [pa.array(list(c), t.type) for c, t in zip(columns, list(CUT_ARROW)[2:])]
            names = [*CUT_ARROW.names, *(["carried"] if carry else [])]
            more = [batch.column("carried")] if carry else []
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("tie"), *values, *more], names=names)

    rows = repeats.texts.join(pairs, ["doc", "tie"], "left")
    schema = CUT
    if carry:
        rows = rows.withColumn("carried", F.struct(*carry)).drop(*carry)
        schema += f", carried {rows.schema['carried'].dataType.simpleString()}"
    return rows.mapInArrow(apply, schema)
