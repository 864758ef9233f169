"""Periodic runs: stretches of consecutive words that repeat with a period, found over a grammar made by recompression.

A run is a stretch of a text with smallest period q (words q apart are equal) that is at least max(LEAST, 4 q) words long
and that no neighbouring word extends. A word is spare if some run contains it after that run's first q words.

Tasks handle some texts at a time, set one after the other with a mark of its own before and after each:

1. Recompression. The words are numbered and compressed in turns: block compression makes one symbol of each stretch of
   equal symbols (by symbol and count), pair compression splits the alphabet by a hash of symbol and turn and makes one
   symbol of each left symbol followed by a right one. Both look at neighbours only, so equal strings get equal
   symbols wherever they stand. This goes on until no symbol stands twice: about a logarithmic number of turns, each
   by a constant factor shorter, which together are the levels of a run-length grammar.
2. Candidates. A run of period q has at least `least - q` places whose word comes again q words on; the multiples of that
   number form a grid that each run meets. All grids together have about n ln n / 3 places, of which those stay
   whose word does come again.
3. Extensions. The longest common extensions of a place and the one q words on, forwards and backwards, come from
   the grammar: symbols are compared and skipped level by level upwards until two differ, and then downwards to the
   differing word. All candidates take each level at once. A mark equals no other symbol, so no text is left.
   Candidates with equal ends are one run; its smallest period is the smallest of theirs.

Work depends on words alone, not on how often they repeat; a task holds one group of texts of about GROUP words, or
one longer text. Nothing is shuffled.

Edge cases: a null, empty or wordless text has no run and collapses to the empty string. Texts of any length go through
whole. Every row stands for itself, so repeated rows and ids give equal rows, and a null doc_id stays null. Ties for the
best run go to the smallest start, then period. Extra columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.hashing import column_bytes, mix

LEAST = 6
# A run holds at least so many periods.
PERIODS = 4
# Words handled at once; a longer text is handled by itself.
GROUP = 1 << 18
# Candidates extended at once.
CANDIDATES = 1 << 18

RUN = "array<struct<start: long, length: long, period: long>>"
RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Edit = Callable[[int | None, list[bytes]], list[bytes]]


class Level(NamedTuple):
    """A string of symbols of the grammar. `up` gives each symbol's parent on the next level, whose children are the
    symbols from `low` to `high`; `block` tells whether parents are blocks or pairs. The last level has no parents."""

    symbols: np.ndarray
    up: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    block: bool = False


def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """A new symbol for each different key, from `fresh` on, and the next unused symbol."""
    different, back = np.unique(keys, return_inverse=True)
    return fresh + back, fresh + len(different)


def _parents(symbols: np.ndarray, first: np.ndarray, block: bool) -> tuple[Level, np.ndarray, np.ndarray]:
    """The level whose parents begin at the marked places, the number of children and the place of the first one."""
    low = np.flatnonzero(first)
    high = np.concatenate((low[1:], [len(symbols)])) - 1
    return Level(symbols, np.cumsum(first) - 1, low, high, block), high - low + 1, low


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels of the run-length grammar of a string of numbers from 0 on, until no symbol stands twice."""
    levels, fresh, turn = [], int(symbols.max(initial=0)) + 1, 0
    symbols = symbols.astype(np.int64)
    while len(np.unique(symbols)) < len(symbols):
        first = np.concatenate(([True], symbols[1:] != symbols[:-1]))
        if not first.all():
            level, size, low = _parents(symbols, first, True)
            levels.append(level)
            symbols, many = symbols[low], size > 1
            symbols[many], fresh = _named(symbols[many] << 32 | size[many], fresh)
        left = mix(symbols.astype(np.uint64), turn) & np.uint64(1) == 0
        joined = left[:-1] & ~left[1:]
        level, size, low = _parents(symbols, np.concatenate(([True], ~joined)), False)
        levels.append(level)
        two = low[size == 2]
        named, fresh = _named(symbols[two] << 32 | symbols[two + 1], fresh)
        symbols = symbols[low]
        symbols[size == 2] = named
        turn += 1
    return [*levels, Level(symbols)]


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray, forwards: bool = True) -> np.ndarray:
    """How many symbols of the string are equal from the places a and b on (backwards: up to them), a differing from b.

    The string must begin and end with symbols that stand nowhere else.
    """
    sign, begin, a, b = 1 if forwards else -1, a, a.copy(), b.copy()
    stopped = np.full(len(a), len(levels) - 1)
    rising = np.arange(len(a))
    # Upwards: as soon as both places are at the edge of their parents, go on with the parents.
    for k, level in enumerate(levels[:-1]):
        edge, far = (level.low, level.high) if forwards else (level.high, level.low)
        risen, here = [], rising
        while len(here):
            x, y = a[here], b[here]
            over_x, over_y = level.up[x], level.up[y]
            ready = (edge[over_x] == x) & (edge[over_y] == y)
            at = here[ready]
            a[at], b[at] = over_x[ready], over_y[ready]
            risen.append(at)
            same = level.symbols[x] == level.symbols[y]
            stopped[here[~ready & ~same]] = k
            on = ~ready & same
            step = np.minimum(abs(far[over_x[on]] - x[on]), abs(far[over_y[on]] - y[on])) + 1 if level.block else 1
            here = here[on]
            a[here] += sign * step
            b[here] += sign * step
        rising = np.concatenate([np.zeros(0, dtype=np.int64), *risen])
    # Downwards: the symbols at the two places differ; so do those below after what their beginnings share.
    for k in range(len(levels) - 2, -1, -1):
        level = levels[k]
        edge, far = (level.low, level.high) if forwards else (level.high, level.low)
        here = np.flatnonzero(stopped > k)
        x, y = a[here], b[here]
        a[here], b[here] = edge[x], edge[y]
        shared = level.symbols[a[here]] == level.symbols[b[here]]
        size = np.minimum(abs(far[x] - edge[x]), abs(far[y] - edge[y])) + 1 if level.block else np.ones(len(x), dtype=np.int64)
        here, size = here[shared], size[shared]
        a[here] += sign * size
        b[here] += sign * size
    return sign * (a - begin)


def _candidates(symbols: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to extend. The texts come from the longest to the shortest, so those that can hold a run of
    a period come first in the string."""
    places, periods, held = [], [], 0
    q = 1
    while True:
        least = max(LEAST, PERIODS * q)
        able = int(np.searchsorted(-sizes, -least, side="right"))
        if not able:
            break
        stop, step = int(ends[able - 1]), least - q
        found = np.flatnonzero(symbols[: stop - q : step] == symbols[q:stop:step]) * step
        if len(found):
            places.append(found), periods.append(np.full(len(found), q))
            held += len(found)
        if held >= CANDIDATES:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
        q += 1
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of a string that holds texts (from the longest to the shortest) between
    marks, by start and period; starts are places of the string."""
    found = [np.zeros((3, 0), dtype=np.int64)]
    levels = None
    for place, period in _candidates(symbols, begins + sizes, sizes):
        levels = levels or grammar(symbols)
        ahead = extensions(levels, place, place + period)
        # One place back on each side: the first place of the string is a mark and never a candidate.
        back = extensions(levels, place - 1, place + period - 1, False)
        start, size = place - back, ahead + back + period
        long = size >= np.maximum(LEAST, PERIODS * period)
        found.append(np.array([start[long], size[long], period[long]]))
        # Equal stretches are one run with the smallest of their periods.
        merged = np.concatenate(found, axis=1)
        merged = merged[:, np.lexsort((merged[2], merged[1], merged[0]))]
        new = np.ones(merged.shape[1], dtype=bool)
        new[1:] = (merged[:2, 1:] != merged[:2, :-1]).any(axis=0)
        found = [merged[:, new]]
    start, size, period = found[0]
    order = np.lexsort((period, start))
    return start[order], size[order], period[order]


def _string(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, with a mark before and after each text, and first places and sizes."""
    known = dict.fromkeys(word for words in texts for word in words)
    known.update(zip(known, range(len(known))))
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    symbols = np.empty(int(sizes.sum()) + len(texts) + 1, dtype=np.int64)
    marks = np.concatenate(([0], begins + sizes))
    symbols[marks] = len(known) + np.arange(len(marks))
    inside = np.ones(len(symbols), dtype=bool)
    inside[marks] = False
    symbols[inside] = np.fromiter((known[word] for words in texts for word in words), dtype=np.int64, count=int(sizes.sum()))
    return symbols, begins, sizes


FOUND_ARROW = pa.schema([("n_words", pa.int64()), ("runs", RUN_ARROW), ("best", pa.int32()), ("collapsed", pa.binary())])


def runs_of(texts: list[list[bytes]]) -> pa.RecordBatch:
    """n_words, runs, place of the best run in them and what is left without the spare words, for each text."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    symbols, begins, sizes = _string([texts[k] for k in order])
    start, size, period = find_runs(symbols, begins, sizes)
    owner = np.searchsorted(begins, start, side="right") - 1
    spare = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(spare, start + period, 1)
    np.add.at(spare, start + size, -1)
    kept = np.cumsum(spare) == 0
    first, last = (np.searchsorted(owner, np.arange(len(texts)), side=side).tolist() for side in ("left", "right"))
    rows = [None] * len(texts)
    for k, at in enumerate(order):
        words, begin = texts[at], int(begins[k])
        if first[k] == last[k]:
            rows[at] = (len(words), [], None, b" ".join(words))
            continue
        mine = slice(first[k], last[k])
        runs = list(zip((start[mine] - begin).tolist(), size[mine].tolist(), period[mine].tolist()))
        best = max(range(len(runs)), key=lambda r: (Fraction(runs[r][1], runs[r][2]), -r))
        left = compress(words, kept[begin : begin + len(words)].tolist())
        rows[at] = (len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], best, b" ".join(left))
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, FOUND_ARROW)], schema=FOUND_ARROW)


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period), best (the run with the greatest
    length / period, null if there is none) and collapsed (UTF-8: the words that are not spare, joined by spaces).

    `edit` may change the words of a row, given its doc_id, before runs are searched.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            raw, ends, ids = data.tobytes(), offsets.tolist(), batch.column("doc_id")
            texts, held, done = [], 0, 0
            for k, doc_id in enumerate(ids.to_pylist()):
                # Without an argument, bytes are split at the white space that ends a word.
                words = raw[ends[k] : ends[k + 1]].split()
                texts.append(edit(doc_id, words) if edit else words)
                held += len(texts[-1])
                if held >= GROUP or k == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(done, len(texts)), *runs_of(texts).columns], names=["doc_id", *FOUND_ARROW.names]
                    )
                    texts, held, done = [], 0, k + 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.mapInArrow(apply, f"doc_id long, n_words long, runs {RUN}, best int, collapsed binary")
    return rows.withColumn("best", F.get("runs", F.col("best")))


def digests(found: DataFrame) -> DataFrame:
    """The rows of `periodic_runs` with runs and collapsed text as hashes."""
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.col("best")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
