"""Language identification by word, with spans of mixed-language texts.

Scripts narrow the candidates of a word to the languages that were learned in that script; character
n-grams of 2 to 4 letters (hashed to BUCKETS) score the word for each of them; Viterbi over the words
with a penalty for each switch labels the spans. The prediction is the language with most letters.

Learned from labelled texts only: of every label at most about SAMPLE_DOCS, picked by a hash of the id, so
that a rare label is learned from all its texts whatever else there is. The counts are summed in Spark; the
driver gets at most BUCKETS numbers per label, and the pieces of text that are scored at once shrink with
the number of labels.

Edge cases: a null or empty text, or one without a letter, is `und` with score 0 and no spans; so is every
text when nothing was learned. Words of a script that no learned language uses say nothing. Equal letter
counts go to the first label in code-point order. A row without a doc_id is predicted, not held out and
not learned from. Long texts are whole; repeated rows are predicted alike; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.hashing import mix

BUCKETS = 1 << 16
SAMPLE_DOCS = 20000
SWITCH_PENALTY = 12.0
# A language uses a script that has at least this share of its letters.
SCRIPT_SHARE = 0.02
# Characters predicted together, and characters whose n-grams are looked up at once.
CHUNK = 1 << 22
PIECE = 1 << 18
# With more labels than this both shrink in proportion.
WIDE = 64

# First and last code points of scripts (letters outside all of them share one more script); fixed values.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF), (0xFB1D, 0xFB4F)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    ("han", [(0x2E80, 0x2FFF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]),
]
N_SCRIPTS = len(SCRIPTS) + 1
_TABLE: list[np.ndarray] = []


def script_of() -> np.ndarray:
    """Script number of each code point, 0 where it is no letter or mark."""
    if not _TABLE:
        table = np.zeros(0x110000, dtype=np.uint8)
        letters = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x40000)])
        table[: len(letters)][letters] = N_SCRIPTS
        for k, (_, ranges) in enumerate(SCRIPTS):
            for first, last in ranges:
                inside = slice(first, min(last, len(letters) - 1) + 1)
                table[inside][letters[inside]] = k + 1
        _TABLE.append(table)
    return _TABLE[0]


class Letters:
    """The letters of some texts: bucket numbers of their n-grams, scripts, and the words and rows they are in."""

    def __init__(self, texts: list[str]):
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        script = script_of()[code]
        at = np.flatnonzero(script)
        self.script = script[at]
        self.new_word = np.concatenate(([True], at[1:] != at[:-1] + 1))[: len(at)]
        self.row = np.searchsorted(np.cumsum(sizes), at, side="right")
        plain = np.where(script > 0, code, 32).astype(np.uint64)
        before, two_before = plain[at - 1], plain[at - 2]
        before = np.where(at > 0, before, 32)
        two_before = np.where((at > 1) & (before != 32), two_before, 32)
        here, after = plain[at], plain[np.minimum(at + 1, len(plain) - 1)]
        shift = np.uint64(21)
        pair = (before << shift) | here
        triple = mix(pair, 41) ^ (after * np.uint64(0x9E3779B97F4A7C15))
        grams = [mix(pair, 42), mix(triple, 43), mix(triple ^ (two_before << np.uint64(32)), 44)]
        self.grams = [(g >> np.uint64(40)).astype(np.int64) % BUCKETS for g in grams]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, bucket, n): n-gram counts, and letters by script as buckets from BUCKETS on."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [t.lower() for t, l in zip(texts, langs) if l == lang]
            counts = np.zeros(BUCKETS + N_SCRIPTS + 1, dtype=np.int64)
            for _, pieces in _pieces(mine, PIECE):
                letters = Letters(pieces)
                for grams in letters.grams:
                    counts[:BUCKETS] += np.bincount(grams, minlength=BUCKETS)
                counts[BUCKETS:] += np.bincount(letters.script, minlength=N_SCRIPTS + 1)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "bucket", "n"]
            )


def _room(size: int, n_labels: int) -> int:
    """How many characters go together if `size` do with WIDE labels or fewer."""
    return max(1, size * WIDE // max(WIDE, n_labels))


def _chunks(texts: list[str], limit: int) -> Iterator[slice]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _pieces(texts: list[str], limit: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Groups of about `limit` characters with the number of the text of each; a longer text is cut at a space where it has one."""
    docs, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > limit:
                stop = max(text.rfind(" ", at, at + limit) + 1, text.rfind("\n", at, at + limit) + 1)
                stop = stop if stop > at else at + limit
            docs.append(i), pieces.append(text[at:stop])
            size += stop - at
            at = stop
            if size >= limit:
                yield np.array(docs), pieces
                docs, pieces, size = [], [], 0
    if pieces:
        yield np.array(docs), pieces


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """From at most about `sample_docs` texts of each label: labels in code-point order, log probabilities (BUCKETS x labels) and which scripts each label uses."""
    spark, span = labelled.sparkSession, 1 << 20
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rows = rows.select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(span)).alias("place"))
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")).collect()
    labels = sorted((row.lang for row in known), key=lambda s: s.encode())
    # Places up to the limit of each label, and its least one in any case.
    limits = [(row.lang, span if row.n <= sample_docs else max(row.least + 1, span * sample_docs // row.n)) for row in known]
    limits = spark.createDataFrame(limits, "lang string, limit long")
    sample = rows.join(F.broadcast(limits), "lang").where("place < limit").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, bucket long, n long")
    table = np.zeros((BUCKETS + N_SCRIPTS + 1, max(1, len(labels))))
    place = {label: k for k, label in enumerate(labels)}
    for row in counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row.bucket, place[row.lang]] = row.n
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    log_p = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    # Relative to the mean over labels, so that a longer word is no less likely than a shorter one.
    log_p -= log_p.mean(axis=1, keepdims=True)
    uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return labels, log_p.astype(np.float32), uses


def viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word. Row r has the words starts[r] to starts[r] + sizes[r]; all rows advance together."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    n_labels = scores.shape[1]
    number = np.min_scalar_type(max(n_labels - 1, 0))
    out = np.zeros(len(scores), dtype=number)
    back = np.zeros(scores.shape, dtype=number)
    own = np.arange(n_labels, dtype=number)
    active = int((sizes > 0).sum())
    state = scores[starts[:active]].astype(np.float64)
    final = np.zeros((active, n_labels))
    going = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0)) + 1), side="left")
    for step in range(1, len(going)):
        # Rows with more than `step` words go on.
        left = int(going[step])
        final[left : len(state)] = state[left:]
        state = state[:left]
        if not left:
            break
        best = state.argmax(axis=1)
        moved = state[np.arange(left), best][:, None] - penalty
        stays = state >= moved
        at = starts[:left] + step
        back[at] = np.where(stays, own, best[:, None].astype(number))
        state = np.where(stays, state, moved) + scores[at]
    label = final.argmax(axis=1)
    for step in range(len(going) - 2, -1, -1):
        here = int(going[step])
        at = starts[:here] + step
        out[at] = label[:here]
        label[:here] = back[at, label[:here]]
    return out


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<first_word:long,n_words:long,lang:string>>"
SPAN = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])
PREDICTED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))]
)


def identify(texts: list[str], labels: list[str], log_p: np.ndarray, uses: np.ndarray, penalty: float) -> list[tuple[str, float, list]]:
    """(label, share of its letters, spans) of each text."""
    none = ("und", 0.0, [])
    if not labels:
        return [none] * len(texts)
    parts = []
    for doc, pieces in _pieces(texts, _room(PIECE, len(labels))):
        letters = Letters([t.lower() for t in pieces])
        if len(letters.row):
            by_letter = log_p[letters.grams[0]] + log_p[letters.grams[1]] + log_p[letters.grams[2]]
            first = np.flatnonzero(letters.new_word)
            size = np.diff(np.concatenate((first, [len(letters.row)])))
            parts.append((np.add.reduceat(by_letter, first, axis=0), size, letters.script[first], doc[letters.row[first]]))
    if not parts:
        return [none] * len(texts)
    scores, size, script, row = (np.concatenate(part) for part in zip(*parts))
    candidates = uses[script]
    known = candidates.any(axis=1)
    scores = np.where(candidates, scores, np.float32(-1e4))
    scores[~known] = 0
    starts = np.searchsorted(row, np.arange(len(texts)))
    sizes = np.searchsorted(row, np.arange(len(texts)), side="right") - starts
    label = viterbi(scores, np.minimum(starts, len(row) - 1), sizes, penalty)
    weight = np.zeros((len(texts), len(labels)))
    np.add.at(weight, (row, label), size)
    border = np.concatenate(([True], (label[1:] != label[:-1]) | (row[1:] != row[:-1])))
    begin = np.flatnonzero(border)
    length = np.diff(np.concatenate((begin, [len(label)])))
    spans: list[list] = [[] for _ in texts]
    for r, b, n, l in zip(row[begin].tolist(), (begin - starts[row[begin]]).tolist(), length.tolist(), label[begin].tolist()):
        spans[r].append({"first_word": b, "n_words": n, "lang": labels[l]})
    best, total = weight.argmax(axis=1), weight.sum(axis=1)
    return [
        (labels[best[r]], float(weight[r, best[r]] / total[r]), spans[r]) if total[r] else none for r in range(len(texts))
    ]


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, held_out (passed through), lang_pred, score and spans of rows (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for chunk in _chunks(texts, _room(CHUNK, len(shared.value[0]))):
                found = identify(texts[chunk], *shared.value, penalty)
                part = batch.slice(chunk.start, chunk.stop - chunk.start)
                label, score, spans = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("held_out"),
                        pa.array(label, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(spans, pa.list_(SPAN)),
                    ],
                    schema=PREDICTED_ARROW,
                )

    return docs.select("doc_id", "held_out", "text").mapInArrow(apply, PREDICTED)


def identify_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Learns from the documents that are not held out (CRC-32 of the id modulo 5 is not 0) and predicts all."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select("doc_id", "lang", "text", held_out.alias("held_out"))
    return predict(rows, learn(rows.where(~F.col("held_out")), sample_docs), penalty)
