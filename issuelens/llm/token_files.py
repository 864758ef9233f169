"""Token ids as wavelet-matrix shards.

Documents are range-partitioned and sorted by id, encoded, closed with END_ID, and written as shards of about
SHARD_TOKENS ids; a document is never split. A shard is one compressed file: the ids as bit planes from
the highest bit down, each plane stably sorted by the one before, in parts of PART bytes compressed by
themselves, with the set bits before each BLOCK bits and the place of each part. From one file any id can be
read, any symbol counted in a range and its occurrences found; only the parts that are met are unpacked. Shards go through the engine's own writer (one row of one Parquet file each), so they reach any store,
and a lost task's files are never seen.

Edge cases: a null or empty text is one END_ID. Rows without a doc_id come first; rows that share an id are
ordered by a hash of their text, and equal rows are written as often as they occur. A special token in a text gets its
own id, as the library does by default. Texts of any length are encoded whole; extra columns are not looked at.
An empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

END_ID = 0
SHARD_TOKENS = 1 << 19
BLOCK = 512
# Bytes of a plane that are compressed together: whole blocks.
PART = 1 << 13
MAGIC = b"WMX2"
# Pieces and words of at most LONGEST characters remembered in each of two generations by a worker.
REMEMBERED = 1_000_000
LONGEST = 64
# Texts encoded at once.
ROWS = 1024


class Plane:
    """Bytes of a bit plane, in parts that are unpacked when they are first asked for."""

    def __init__(self, n_bytes: int, parts: list, packed: bool):
        self.n_bytes, self.parts = n_bytes, parts
        self.known: dict[int, np.ndarray] = {} if packed else dict(enumerate(parts))

    @classmethod
    def of(cls, data: np.ndarray) -> Plane:
        return cls(len(data), [data[at : at + PART] for at in range(0, len(data), PART)], False)

    def part(self, k: int) -> np.ndarray:
        if k not in self.known:
            raw = zstandard.ZstdDecompressor().decompress(self.parts[k], max_output_size=PART)
            self.known[k] = np.frombuffer(raw, dtype=np.uint8)
        return self.known[k]

    def within(self, first: int, last: int) -> np.ndarray:
        """Bytes first to last, which lie in one part."""
        k = first // PART
        return self.part(k)[first - k * PART : last - k * PART]

    def whole(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=np.uint8), *map(self.part, range(len(self.parts)))])


class WaveletMatrix:
    """Ids as bit planes with rank and select."""

    def __init__(self, size: int, zeros: list[int], planes: list[Plane], ranks: list[np.ndarray | None] | None = None):
        self.size, self.zeros, self.planes = size, zeros, planes
        self._ranks = ranks or [None] * len(planes)

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        rest, zeros, planes = ids, [], []
        for k in range(bits - 1, -1, -1):
            bit = (rest >> rest.dtype.type(k)) & rest.dtype.type(1) != 0
            planes.append(Plane.of(np.packbits(bit)))
            rest = np.concatenate((rest[~bit], rest[bit]))
            zeros.append(len(bit) - int(np.count_nonzero(bit)))
        return cls(len(ids), zeros, planes)

    def _blocks(self, k: int) -> np.ndarray:
        """Set bits before each block of plane k."""
        if self._ranks[k] is None:
            ones = np.bitwise_count(self.planes[k].whole()).astype(np.int64)
            per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
            self._ranks[k] = np.concatenate(([0], np.cumsum(per)))
        return self._ranks[k]

    def rank(self, k: int, at: int) -> int:
        """Set bits of plane k before place `at`."""
        block, n_bytes = at // BLOCK, at % BLOCK // 8
        n = int(self._blocks(k)[block])
        if at % BLOCK == 0:
            return n
        first = block * (BLOCK // 8)
        bits = self.planes[k].within(first, first + n_bytes + 1)
        n += int(np.bitwise_count(bits[:n_bytes]).sum())
        return n + (int(bits[n_bytes]) >> (8 - at % 8)).bit_count() if at % 8 else n

    def _bit(self, k: int, at: int) -> int:
        return int(self.planes[k].within(at // 8, at // 8 + 1)[0]) >> (7 - at % 8) & 1

    def access(self, at: int) -> int:
        value = 0
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, at), self.rank(k, at)
            value = value << 1 | bit
            at = self.zeros[k] + ones if bit else at - ones
        return value

    def _range(self, symbol: int, start: int, end: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self.rank(k, start), self.rank(k, end)
            bit = symbol >> (len(self.planes) - 1 - k) & 1
            start, end = (self.zeros[k] + a, self.zeros[k] + b) if bit else (start - a, end - b)
        return start, end

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a symbol in places start to end."""
        a, b = self._range(symbol, start, self.size if end is None else end)
        return b - a

    def select(self, symbol: int, nth: int) -> int:
        """Place of the nth occurrence (from 0) of a symbol."""
        at = self._range(symbol, 0, self.size)[0] + nth
        for k in range(len(self.planes) - 1, -1, -1):
            bit = symbol >> (len(self.planes) - 1 - k) & 1
            at = self._select_bit(k, bit, at - self.zeros[k] if bit else at)
        return at

    def _select_bit(self, k: int, bit: int, nth: int) -> int:
        ones = self._blocks(k)
        seen = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.size) - ones
        block = int(np.searchsorted(seen, nth, side="right")) - 1
        first = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[k].within(first, first + BLOCK // 8))[: self.size - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[nth - int(seen[block])])

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, n) for n in range(self.count(symbol))]

    def ids(self) -> np.ndarray:
        """All ids in order: the stable sorts undone from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        below = np.zeros(self.size, dtype=kind)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k].whole(), count=self.size).view(bool)
            here = np.empty(self.size, dtype=kind)
            here[~bit] = below[: self.zeros[k]]
            here[bit] = below[self.zeros[k] :] | kind(1 << (len(self.planes) - 1 - k))
            below = here
        return below

    def to_bytes(self) -> bytes:
        """Size, planes and zeros; per plane the set bits before each block, then the ends of its parts; all parts."""
        pack = zstandard.ZstdCompressor(level=1)
        head = struct.pack("<QB", self.size, len(self.planes)) + struct.pack(f"<{len(self.zeros)}Q", *self.zeros)
        parts = [[pack.compress(plane.part(k).tobytes()) for k in range(len(plane.parts))] for plane in self.planes]
        ranks = [self._blocks(k).astype("<u4").tobytes() for k in range(len(self.planes))]
        ends = np.cumsum([len(part) for plane in parts for part in plane], dtype="<u8").tobytes()
        return head + b"".join(ranks) + ends + b"".join(part for plane in parts for part in plane)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        size, bits = struct.unpack_from("<QB", data)
        zeros = list(struct.unpack_from(f"<{bits}Q", data, 9))
        n_bytes = -(-size // 8)
        n_ranks, n_parts = -(-size // BLOCK) + 1, -(-n_bytes // PART)
        at = 9 + 8 * bits
        ranks = list(np.frombuffer(data, dtype="<u4", count=bits * n_ranks, offset=at).reshape(bits, n_ranks))
        at += 4 * bits * n_ranks
        ends = [0, *np.frombuffer(data, dtype="<u8", count=bits * n_parts, offset=at).tolist()]
        packed = memoryview(data)[at + 8 * bits * n_parts :]
        parts = [packed[a:b] for a, b in zip(ends, ends[1:])]
        planes = [Plane(n_bytes, parts[k * n_parts : (k + 1) * n_parts], True) for k in range(bits)]
        return cls(size, zeros, planes, ranks)


def shard_bytes(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """The file of one shard: MAGIC, length of the index, index (ids and sizes of the documents), matrix."""
    sink = pa.BufferOutputStream()
    index = pa.record_batch([doc_ids, pa.array(sizes.astype(np.int64))], names=["doc_id", "n"])
    with pa.ipc.new_stream(sink, index.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(index)
    index_bytes = sink.getvalue().to_pybytes()
    return MAGIC + struct.pack("<I", len(index_bytes)) + index_bytes + WaveletMatrix.of(ids, bits).to_bytes()


def read_shard(data: bytes) -> tuple[pa.RecordBatch, WaveletMatrix]:
    if data[:4] != MAGIC:
        raise ValueError("not a shard")
    (n,) = struct.unpack_from("<I", data, 4)
    index = pa.ipc.open_stream(data[8 : 8 + n]).read_next_batch()
    return index, WaveletMatrix.from_bytes(data[8 + n :])


# Texts that are not cut at spaces: with a space before white space or at the end, or with the mark of a cut.
UNCUT = r" [\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]| \z|\x{0}"
# Pieces sent to the library as one text.
TOGETHER = 4096


class Encoder:
    """Ids of texts by the tokenizers library. Where the library itself encodes the words of a byte-level pattern one by
    one, a space before anything but white space begins a word: texts are cut there by Arrow, and each worker keeps the ids
    of the pieces and words it has seen, in two generations, so that those in use stay when the older one is dropped. New
    pieces go to the library as one text; only a piece's first id begins with a space. Pieces too long to be kept and texts
    that are not cut are taken by words; texts that hold a special token, which may span words, go to the library whole."""

    def __init__(self, definition: str, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        by_word = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.words = regex.compile(pattern) if pattern and by_word and not parts.get("normalizer") else None
        self.special = [token["content"] for token in parts.get("added_tokens") or []]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Ids whose token begins with a space, which the byte-level alphabet writes as this letter.
        self.spaced = np.zeros(1 << self.bits, dtype=bool)
        self.spaced[[n for token, n in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(found), dtype=self.kind).tobytes()
        ends = [0, *accumulate(len(ids) * self.kind().itemsize for ids in found)]
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def _learn(self, used: set[str]) -> list[str]:
        """Puts all used words into the younger generation; returns those too long to be kept."""
        new = []
        for word in used.difference(self.young):
            ids = self.old.get(word)
            if ids is None:
                new.append(word)
            else:
                self.young[word] = ids
        self.young.update(zip(new, self._raw(new)))
        return [word for word in new if len(word) > LONGEST]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [self.words.findall(text) for text in texts]
        long = self._learn(set().union(*split))
        out = [b"".join(map(self.young.__getitem__, words)) for words in split]
        for word in long:
            del self.young[word]
        return out

    def _spaced(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with their only space."""
        out = []
        for at in range(0, len(pieces), TOGETHER):
            some = pieces[at : at + TOGETHER]
            ids = np.frombuffer(self._raw(["".join(some)])[0], dtype=self.kind)
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some):
                out += self._raw(some)
                continue
            raw, width = ids.tobytes(), ids.itemsize
            ends = [*(starts * width).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces; those in use are put into the younger generation."""
        out = [self.young.get(piece) for piece in pieces]
        new, others = [], []
        for k in (k for k, ids in enumerate(out) if ids is None):
            piece = pieces[k]
            ids = self.old.get(piece)
            if ids is not None:
                out[k] = self.young[piece] = ids
            elif piece[:1] == " " and len(piece) <= LONGEST:
                new.append(k)
            else:
                others.append(k)
        names = [pieces[k] for k in new]
        found = self._spaced(names)
        self.young.update(zip(names, found))
        for k, ids in zip(chain(new, others), chain(found, self._by_words([pieces[k] for k in others]))):
            out[k] = ids
        return out

    def _cut(self, texts: pa.Array) -> list[bytes]:
        cut = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
        pieces = cut.flatten().dictionary_encode()
        ids = pa.array(self._pieces(pieces.dictionary.to_pylist()), pa.large_binary()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[cut.offsets.to_numpy()].tolist()
        raw = memoryview(ids.buffers()[2]) if ids.buffers()[2] else memoryview(b"")
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.words is None:
            return self._raw(texts)
        out: list[bytes] = [b""] * len(texts)
        rows = pa.array(texts, pa.large_string())
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.special:
            whole |= pc.match_substring(rows, token).to_numpy(zero_copy_only=False)
        uncut = pc.match_substring_regex(rows, UNCUT).to_numpy(zero_copy_only=False)
        for some, by in [
            (whole, self._raw),
            (uncut & ~whole, self._by_words),
            (~uncut & ~whole, lambda found: self._cut(pa.array(found, pa.large_string()))),
        ]:
            places = np.flatnonzero(some).tolist()
            for k, ids in zip(places, by([texts[k] for k in places]) if places else []):
                out[k] = ids
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        return out


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}
SHARD = "part int, seq int, first_doc long, n_tokens long, file binary"


def write_shards(docs: DataFrame, tokenizer_path: str, pattern: str | None, folder: str) -> None:
    """Encodes doc_id and text and writes the shards below `folder`, in ascending order of doc_id."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = definition.value, pattern
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(*key)
        encoder = _ENCODERS[key]
        end = encoder.kind(END_ID).tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        names, held, size = [], [], 0

        def shard() -> pa.RecordBatch:
            doc_ids = pa.concat_arrays(names)
            ids = np.frombuffer(b"".join(held), dtype=encoder.kind)
            sizes = np.array([len(h) for h in held]) // ids.itemsize
            data = shard_bytes(doc_ids, sizes, ids, encoder.bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), doc_ids[:1], pa.array([len(ids)]), pa.array([data], pa.binary())],
                names=["part", "seq", "first_doc", "n_tokens", "file"],
            )

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                for k, ids in enumerate(encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
                    names.append(batch.column("doc_id").slice(k, 1))
                    held.append(ids + end)
                    size += len(held[-1]) // len(end)
                    if size >= SHARD_TOKENS:
                        yield shard()
                        names, held, size, seq = [], [], 0, seq + 1
        if held:
            yield shard()

    order = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text"]
    ordered = docs.select(*order).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shards = ordered.select("doc_id", "text").mapInArrow(apply, SHARD)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(folder)


READ = "part int, seq int, doc_id long, place long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, data in zip(batch.column("part"), batch.column("seq"), batch.column("file")):
            index, matrix = read_shard(data.as_py())
            sizes = index.column("n").to_numpy()
            ends = np.cumsum(sizes)
            raw = memoryview(matrix.ids().astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.as_py()] * rows, pa.int32()),
                    pa.array([seq.as_py()] * rows, pa.int32()),
                    index.column("doc_id"),
                    pa.array(ends - sizes),
                    pa.array(sizes),
                    pa.array(crcs, pa.int64()),
                ],
                names=["part", "seq", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    files = spark.read.parquet(folder)
    sizes = files.select("part", "seq", "n_tokens")
    inner = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    inner = sizes.select("part", "seq", F.coalesce(inner, F.lit(0)).alias("inner"))
    # One row per range of the writer.
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    outer = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    outer = totals.select("part", F.coalesce(outer, F.lit(0)).alias("outer"))
    offsets = inner.join(outer, "part")
    rows = files.select("part", "seq", "file").mapInArrow(_read, READ).join(offsets, ["part", "seq"])
    return rows.select("doc_id", (F.col("outer") + F.col("inner") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
