import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vecshoal.llm import residual_packing

from .conftest import EDGE

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokens():
    return residual_packing.ByteTokens(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t \x1cab1'.")), max_size=60))
def test_ids_are_those_of_the_tokenizer(tokenizer, tokens, text):
    assert np.frombuffer(tokens.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "a  b   c \n d\n\n e", "<|endoftext|> x <|endoftext|>", "it's we'll 12 34%", " leading", "trailing ", " " * 2_000_000 + "x", "x" * 50_000, "\n" * 50_000])
def test_ids_of_odd_texts(tokenizer, tokens, text):
    assert tokens.merges is not None
    assert np.frombuffer(tokens.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_used_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    other = residual_packing.ByteTokens(path)
    assert other.merges is None
    assert np.frombuffer(other.encode("two  words"), dtype="<u4").tolist() == Tokenizer.from_file(path).encode("two  words", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_places_each_item_in_the_tightest_bin(sizes):
    bins = residual_packing.best_fit(sizes, 40)
    assert sorted(i for members in bins for i in members) == list(range(len(sizes)))
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [room for room in rooms if room >= size]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else 40) - size)
    assert sorted(40 - sum(sizes[i] for i in members) for members in bins) == sorted(rooms)


def check(rows, packed, tokenizer, window):
    """All ids in place, nothing cut but long documents; the number of sequences."""
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packed:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(ids) == r.length
        pieces[r.doc_id].append((r.piece, r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for doc_id, texts in want.items():
        if len(texts) > 1:
            assert sum(len(ids) for _, _, ids in pieces[doc_id]) == sum(map(len, texts))
            continue
        at = 0
        for number, (piece, start, ids) in enumerate(sorted(pieces[doc_id])):
            assert (piece, start) == (number, at) and ids == texts[0][at : at + len(ids)]
            assert len(ids) == window or number == 0
            at += len(ids)
        assert at == len(texts[0])
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= window
    return len(sequences)


@pytest.mark.parametrize("how", [{}, {"fan": 2, "least_carried": 3, "buffer_ids": 500}, {"window": 64, "slack": 0}])
def test_round_trip(spark, prose, tokenizer, how):
    texts = [*EDGE, *prose(150, seed=4, words=300)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, bin int, open int, ids int").repartition(9)
    packed = residual_packing.pack_whole(docs, PATH, **how).collect()
    window = how.get("window", 1024)
    count = check(rows, packed, tokenizer, window)
    total = sum(r.length for r in packed)
    if not how:
        assert count <= 1.08 * -(-total // window) + 1


def test_underfull_bins_of_all_partitions_meet(spark, tokenizer):
    """Texts of 10 to 20 ids in 40 partitions of one row each fit few sequences once bins have gone up the tree."""
    rng = random.Random(1)
    rows = [(i, "word " * rng.randint(10, 20)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40, "doc_id")
    for how in ({}, {"fan": 2, "least_carried": 1}):
        packed = residual_packing.pack_whole(docs, PATH, **how).collect()
        assert check(rows, packed, tokenizer, 1024) == 1


def test_ids_missing_or_repeated_and_no_rows(spark, tokenizer):
    rows = [(None, "some text"), (None, None), ("b", "twice"), ("b", "twice"), ("c", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    packed = residual_packing.pack_whole(docs, PATH).collect()
    check(rows, packed, tokenizer, 1024)
    assert len(packed) == 5
    assert residual_packing.pack_whole(docs.limit(0), PATH).count() == 0
