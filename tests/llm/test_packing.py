import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vecshoal.llm import packing

from .conftest import EDGE

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return packing.WordTokens(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer(tokenizer, words, text):
    found = np.frombuffer(words.encode([text])[0], dtype="<u4").tolist()
    assert found == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["It's we'll ÇA  va bien", "<|endoftext|> x", "İstanbul ΣΑΣ ½ ² 12.5", "don't\r\n\tstop!!%%%", "é ́x"])
def test_ids_of_odd_words(tokenizer, words, text):
    assert np.frombuffer(words.encode([text])[0], dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_the_plain_way():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = packing.WordTokens(path)
    assert not plain.by_word
    text = "two  words\nhere"
    assert np.frombuffer(plain.encode([text])[0], dtype="<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=120))
def test_best_fit_decreasing_matches_a_scan(lengths):
    found = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room[room.index(min(fits))] -= length
        else:
            room.append(64 - length)
    assert sorted(p for window in found for p in window) == list(range(len(lengths)))
    assert sorted(64 - sum(lengths[p] for p in window) for window in found) == sorted(room)


def check(rows, texts, tokenizer, window):
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for t in texts]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    for number, ids in enumerate(want):
        pieces = sorted(by_doc[number], key=lambda r: r.start)
        assert b"".join(bytes(p.ids) for p in pieces) == ids.tobytes()
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert {p.doc_tokens for p in pieces} == {len(ids)}
        assert all(zlib.crc32(bytes(p.ids)) == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert sum(p.length for p in pieces) <= window
    return by_sequence


def test_round_trip_and_little_padding(documents, prose, tokenizer):
    texts = [*EDGE, *prose(400)]
    sequences = check(packing.pack(documents(texts), PATH, window=256).collect(), texts, tokenizer, 256)
    used = sum(p.length for pieces in sequences.values() for p in pieces)
    assert used >= 0.98 * 256 * (len(sequences) - 3)


def test_small_buffers_carry_over(documents, prose, tokenizer):
    texts = prose(300)
    sequences = check(packing.pack(documents(texts).coalesce(1), PATH, window=256, buffer_tokens=3000).collect(), texts, tokenizer, 256)
    assert sum(p.length for pieces in sequences.values() for p in pieces) >= 0.97 * 256 * (len(sequences) - 1)


def test_empty_table_repeated_rows_and_odd_columns(spark, documents):
    assert packing.pack(documents([]), PATH).count() == 0
    rows = packing.pack(documents([(5, "a b"), (5, "a b"), (None, "c")]), PATH).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 3), (False, 3), (True, 2)]
    odd = documents(["a b c"]).selectExpr("*", "1 as start", "2 as length", "'x' as ids", "3 as sequence_id")
    assert packing.pack(odd, PATH).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert packing.pack(odd, PATH).count() == 1


def test_a_worker_keeps_its_encoder(spark):
    """Tasks of one worker share the encoder and its words, though their functions come anew."""

    def task(batches):
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "encoder": [id(packing.word_tokens(PATH))]})

    seen = set()
    for _ in range(3):
        seen |= {tuple(r) for r in spark.range(4).coalesce(1).mapInArrow(task, "pid long, encoder long").collect()}
    assert len(seen) == len({pid for pid, _ in seen})
    assert packing.word_tokens(PATH) is packing.word_tokens(PATH)
