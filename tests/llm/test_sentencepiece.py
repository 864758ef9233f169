import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from issuelens.llm import sentencepiece_units as units

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return units.Units(units.load_pieces(MODEL))


def best_score(pieces, unknown, text):
    """Highest total over all segmentations, by trying every last piece."""
    best = [0.0]
    for end in range(1, len(text) + 1):
        best.append(max([best[end - 1] + unknown] + [best[s] + pieces[text[s:end]] for s in range(max(0, end - 24), end) if text[s:end] in pieces]))
    return best[-1]


def score_of(encoder, ids):
    """Scores of the pieces, and the price of an unknown character for each run of its bytes."""
    is_byte = set(encoder.byte_ids)
    total, i = 0.0, 0
    while i < len(ids):
        if ids[i] in is_byte:
            first = encoder.bytes_of[ids[i]][0]
            i += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            total += encoder.unknown
        else:
            total += encoder.scores[ids[i]]
            i += 1
    return total


def test_path_is_best(encoder, texts):
    pieces = {p.replace(units.MARKER, " "): s for p, s, k in units.load_pieces(MODEL) if k == "piece" and s > units.UNUSED}
    for text in [*list(texts.values())[:15], " a  b ", "\n\na\t", "日本語 ☃ \U0001f600", "<0x0A> <s> </s>", "\x00"]:
        ids = encoder.encode(text).tolist()
        assert abs(score_of(encoder, ids) - best_score(pieces, encoder.unknown, " " + text)) < 1e-6


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_round_trip_of_any_text(text):
    encoder = test_round_trip_of_any_text.__dict__.setdefault("encoder", units.Units(units.load_pieces(MODEL)))
    assert encoder.decode(encoder.encode(text)) == text


def test_trie_finds_exactly_its_words():
    words = {b"a": 1, b"ab": 2, b"abc": 3, b"\x00": 4, b"b\xff": 5, b"bcd": 6}
    trie = units.DoubleArray(words)
    for data in (b"abcd", b"b\xff", b"\x00a", b"bcde", b"zz", b""):
        assert list(trie.prefixes(data, 0)) == [(n, words[data[:n]]) for n in range(1, len(data) + 1) if data[:n] in words]


def test_tables(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        encoded = units.encode(docs, MODEL)
        rows = encoded.collect()
        assert len(rows) == docs.count() and all(row.round_trip and row.n_tokens == len(row.ids) for row in rows)
        back = sorted((r.doc_id or 0, r.text) for r in units.decode(encoded, MODEL).collect())
        assert back == sorted((r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert units.encode(no_documents, MODEL).count() == 0
