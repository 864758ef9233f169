"""SentencePiece encoding: Unigram Viterbi over a double-array trie of the pieces, with byte fallback, and decoding.

The pieces and log scores come from a model file; its special, byte and unused entries take no part in
matching. A text gets one leading space, spaces are the model's white-space marker, and the path with the
highest total score wins; equal scores go to the path whose last piece starts later. A character that no piece matches costs
the lowest piece score less UNKNOWN and is written as its UTF-8 bytes. A literal marker character in a text is
written as bytes, so decoding always gives the text back.

Pieces that span a marker are runs of markers only, so a text may be cut before each run of spaces and at each
newline (which no piece holds) without changing the best path; each worker remembers the units it has seen.

Edge cases: a null or empty text has no ids and decodes to the empty text. A long text is a long list of
units; a unit without spaces is searched in time linear in its length. Repeated rows are encoded alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARKER = "▁"
UNKNOWN = 10.0
# Units remembered by a worker; the memory is emptied when it is full.
REMEMBERED = 500_000
# Scores below this mark entries that training never gives out.
UNUSED = -1e8


class DoubleArray:
    """A trie over bytes in two integer lists: child c of node s is base[s] + c + 1 if check there is s."""

    def __init__(self, words: dict[bytes, int]):
        root: dict = {}
        for word, value in words.items():
            node = root
            for byte in word:
                node = node.setdefault(byte, {})
            node[-1] = value
        self.base, self.check, self.value = [0] * 1024, [-1] * 1024, [-1] * 1024
        self.check[0] = 0
        # Nodes with several children go behind all that is placed; single children fill the gaps left between.
        single, waiting = [], [(0, root)]
        top = gap = 1
        while waiting or single:
            state, node = waiting.pop() if waiting else single.pop()
            self.value[state] = node.get(-1, -1)
            labels = sorted(c + 1 for c in node if c >= 0)
            if not labels:
                continue
            if len(labels) == 1:
                gap = max(gap, labels[0])
                self._room(gap + 2)
                while self.check[gap] >= 0:
                    gap += 1
                    self._room(gap + 2)
                start = gap - labels[0]
            else:
                start = max(top - labels[0], 0)
                if start + labels[0] < top:
                    start = top
            top = max(top, start + labels[-1] + 1)
            self._room(start + 512)
            self.base[state] = start
            for c in labels:
                self.check[start + c] = state
            for c in labels:
                child = node[c - 1]
                (single if sum(k >= 0 for k in child) < 2 else waiting).append((start + c, child))

    def prefixes(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, value) of every stored word that starts at `at`."""
        state = 0
        for end in range(at, len(data)):
            following = self.base[state] + data[end] + 1
            if self.check[following] != state:
                return
            state = following
            if self.value[state] >= 0:
                yield end + 1, self.value[state]

    def _room(self, size: int) -> None:
        while len(self.check) < size:
            more = len(self.check)
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Units:
    """Encoder and decoder for one list of (piece, score, kind); kind is 'piece', 'byte' or 'other'."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.scores = [score for _, score, _ in pieces]
        matched = {p.replace(MARKER, " ").encode(): i for i, (p, s, k) in enumerate(pieces) if k == "piece" and p and s > UNUSED}
        self.trie = DoubleArray(matched)
        self.bytes_of = [p.replace(MARKER, " ").encode() if k == "piece" else b"" for p, _, k in pieces]
        self.byte_ids = [0] * 256
        for i, (p, _, k) in enumerate(pieces):
            if k == "byte":
                value = int(p[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
        self.unknown = min((self.scores[i] for i in matched.values()), default=0.0) - UNKNOWN
        spans = any(b" " in w.lstrip(b" ") or b"\n" in w for w in matched)
        # Cut before runs of spaces and around newlines, unless some piece reaches across.
        self.unit = re.compile(r"(?s).+" if spans else r" *[^ \n]+| +|\n")
        self.known: dict[str, bytes] = {}

    def best_path(self, data: bytes) -> list[int]:
        """Ids of the highest-scoring segmentation of UTF-8 bytes."""
        n = len(data)
        best, back, last = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, value, scores, unknown = self.trie.base, self.trie.check, self.trie.value, self.scores, self.unknown
        at = 0
        while at < n:
            here, state = best[at], 0
            first = data[at]
            step = at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
            if here + unknown > best[step]:
                best[step], back[step], last[step] = here + unknown, at, -1
            for end in range(at, n):
                following = base[state] + data[end] + 1
                if check[following] != state:
                    break
                state = following
                piece = value[state]
                if piece >= 0 and here + scores[piece] >= best[end + 1]:
                    best[end + 1], back[end + 1], last[end + 1] = here + scores[piece], at, piece
            at = step
        ids, end = [], n
        while end:
            at, piece = back[end], last[end]
            ids.extend([piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(data[at:end])])
            end = at
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        units = self.unit.findall(" " + text)
        new = set(units).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(units)
        for unit in new:
            self.known[unit] = np.array(self.best_path(unit.encode()), dtype=np.int32).tobytes()
        return np.frombuffer(b"".join(map(self.known.__getitem__, units)), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, np.asarray(ids, dtype=np.int32).tolist())).decode("utf-8", "replace")
        return text[1:]


def load_pieces(path: str) -> list[tuple[str, float, str]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "other" if model.is_unknown(i) or model.is_control(i) or model.is_unused(i) else "piece"

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())]


_LOADED: dict[str, tuple[int, Units]] = {}


def _units(name: str, pieces: list[tuple[str, float, str]]) -> Units:
    """The encoder of a worker for one model, built once."""
    mark = hash(tuple(pieces))
    if name not in _LOADED or _LOADED[name][0] != mark:
        _LOADED.clear()
        _LOADED[name] = mark, Units(pieces)
    return _LOADED[name][1]


ENCODED = "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean"
ENCODED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]
)
# Rows of one output batch.
ROWS = 200


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, their number, how many are bytes, their CRC (32-bit little-endian), and whether decoding gives the text back."""
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(model_path, pieces.value)
        is_byte = np.zeros(len(units.bytes_of), dtype=bool)
        is_byte[units.byte_ids] = True
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                arrays, same = [], []
                for text in batch.column("text"):
                    text = text.as_py() or ""
                    ids = units.encode(text)
                    arrays.append(ids)
                    same.append(units.decode(ids) == text)
                sizes = [len(x) for x in arrays]
                flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        ids,
                        pa.array(sizes, pa.int64()),
                        pa.array([int(is_byte[x].sum()) for x in arrays], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in arrays], pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    schema=ENCODED_ARROW,
                )

    return docs.select("doc_id", "text").mapInArrow(apply, ENCODED)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text of its `ids`; null ids give the empty text."""
    pieces = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(model_path, pieces.value)
        for batch in batches:
            texts = [units.decode(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(apply, "doc_id long, text string")
