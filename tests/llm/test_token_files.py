import functools
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from issuelens.llm import token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def one_encoder():
    with open(TOKENIZER, encoding="utf-8") as file:
        return token_files.Encoder(file.read(), public_tokenizers.PATTERN)


def test_matrix_answers_as_the_plain_ids_do():
    rng = np.random.default_rng(4)
    for size in (0, 1, 511, 512, 513, 6000):
        ids = rng.integers(0, 300, size).astype(np.uint16)
        matrix = token_files.WaveletMatrix.from_bytes(token_files.WaveletMatrix.of(ids, 16).to_bytes())
        assert (matrix.ids() == ids).all()
        assert [matrix.access(i) for i in range(0, size, 41)] == ids[::41].tolist()
        for symbol in (0, 7, 299, 65535) if size else ():
            assert matrix.occurrences(symbol) == np.flatnonzero(ids == symbol).tolist()
            assert matrix.count(symbol, size // 3, size // 2) == int((ids[size // 3 : size // 2] == symbol).sum())


def test_a_file_is_asked_without_unpacking_the_rest():
    ids = np.random.default_rng(5).integers(0, 300, 300_000).astype(np.uint16)
    made = token_files.WaveletMatrix.of(ids, 16)
    matrix = token_files.WaveletMatrix.from_bytes(made.to_bytes())
    unpacked = lambda: [len(plane.known) for plane in matrix.planes]
    # The counts of all planes are in the file.
    assert all((matrix._ranks[k] == made._blocks(k)).all() for k in range(16)) and not any(unpacked())
    assert matrix.access(200_001) == ids[200_001] and max(unpacked()) == 1
    assert matrix.count(7) == int((ids == 7).sum()) and max(unpacked()) <= 3 < len(matrix.planes[0].parts)
    assert matrix.select(7, 50) == np.flatnonzero(ids == 7)[50] and (matrix.ids() == ids).all()


def expected(ordered):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    out, start = [], 0
    for doc_id, text in ordered:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, docs, folder):
    token_files.write_shards(docs, TOKENIZER, public_tokenizers.PATTERN, folder)
    return [tuple(r) for r in token_files.read_documents(spark, folder).orderBy("start").collect()]


def test_files_hold_all_ids_in_order(spark, documents, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_TOKENS", 9000)
    special = spark.createDataFrame([(10**9, "a <|endoftext|> b", "en", "s", 1)], documents.schema)
    got = written(spark, documents.unionByName(special), str(tmp_path / "shards"))
    assert got == expected([*sorted(texts.items()), (10**9, "a <|endoftext|> b")])
    files = spark.read.parquet(str(tmp_path / "shards"))
    assert files.count() > 5 and files.inputFiles().__len__() >= files.count()


def test_odd_rows(spark, odd_documents, no_documents, tmp_path):
    got = written(spark, odd_documents, str(tmp_path / "odd"))
    assert len(got) == odd_documents.count()
    lengths = sorted(n for _, _, n, _ in expected([(r.doc_id, r.text) for r in odd_documents.collect()]))
    assert sorted(n for _, _, n, _ in got) == lengths
    assert [start for _, start, _, _ in got] == [sum(n for _, _, n, _ in got[:i]) for i in range(len(got))]
    assert written(spark, no_documents, str(tmp_path / "none")) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é日's1.,\n\t \xa0\u2003\x1c\x85"), max_size=40), max_size=6), st.integers(0, 4))
def test_pieces_give_the_ids_of_whole_texts(texts, remembered):
    plain = Tokenizer.from_file(TOKENIZER)
    encoder = one_encoder()
    texts = [*texts, "x" * 100 + " " + "y" * 100, "a <|endoftext|> b", " <|endoftext|>"]
    before, token_files.REMEMBERED = token_files.REMEMBERED, remembered
    try:
        got = encoder.encode(texts) + encoder.encode(texts[::-1])
    finally:
        token_files.REMEMBERED = before
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, dtype=np.uint16).tobytes() for t in texts + texts[::-1]]
    assert got == want
    assert all(len(piece) <= token_files.LONGEST for memory in (encoder.young, encoder.old) for piece in memory)


def test_new_pieces_go_to_the_library_together(monkeypatch):
    plain = Tokenizer.from_file(TOKENIZER)
    encoder = one_encoder()
    calls, raw = [], encoder._raw
    monkeypatch.setattr(encoder, "_raw", lambda texts: calls.append(len(texts)) or raw(texts))
    monkeypatch.setattr(encoder, "young", {})
    monkeypatch.setattr(encoder, "old", {})
    texts = [
        "".join(f" wörd{k},don's\n" + "x" * (k % 3) for k in range(500)), "a  b", "a ", " a", "", "tab\t b", "日本 語です。 x" * 9,
        "mark \0 b", "a \x1c b", "Ġ Ġx", "two  b  c",
    ]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, dtype=np.uint16).tobytes() for t in texts]
    assert encoder.encode(texts) == want
    # The 500 pieces of the first text took one text of the library, not one each.
    assert sum(calls) < 100
    assert encoder.encode(texts) == want
