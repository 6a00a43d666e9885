import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecshoal.llm import substrings

from .conftest import EDGE


def brute(rows):
    """``(bytes left, spans)`` by row number, from all strings of all documents."""
    out = [None] * len(rows)
    seen = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        if doc_id is not None:
            for i in range(len(data) - 49):
                s = data[i : i + 50]
                seen[s] = min(seen.get(s, doc_id), doc_id)
    for number, (doc_id, text) in enumerate(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        if doc_id is not None:
            for i in range(len(data) - 49):
                if seen[data[i : i + 50]] < doc_id:
                    gone[i : i + 50] = True
        left = bytes(np.frombuffer(data, dtype=np.uint8)[~gone[:-1]])
        out[number] = left, int((gone[1:] < gone[:-1]).sum())
    return out


def shared_passages(prose, seed, count=50):
    rng = random.Random(seed)
    texts = prose(count, seed=seed)
    for _ in range(count * 2):
        a, b = rng.randrange(count), rng.randrange(count)
        start, size = rng.randrange(max(1, len(texts[a]) - 60)), rng.choice([30, 48, 49, 50, 51, 60, 90, 300])
        at = rng.randrange(len(texts[b]))
        texts[b] = texts[b][:at] + texts[a][start : start + size] + texts[b][at:]
    return texts


@pytest.mark.parametrize("most", [100_000, 2])
def test_against_all_strings(documents, prose, most):
    texts = [*EDGE, "x" * 5000, "ab" * 700, "ab" * 40 + "c" + "ab" * 40, "ü" * 100, "😀" * 30, *shared_passages(prose, 2)]
    ids = random.Random(4).sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    got = {r.doc_id: (bytes(r.kept), r.n_spans, r.n_bytes, r.n_removed) for r in substrings.remove_repeats(documents(rows), most_contexts=most).collect()}
    for (doc_id, text), (left, spans) in zip(rows, brute(rows)):
        size = len((text or "").encode())
        assert got[doc_id] == (left, spans, size, size - len(left))


def test_small_buckets_merges_and_parts(documents, prose, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substrings, "HELD_ANCHORS", 40)
    monkeypatch.setattr(substrings, "PART_ANCHORS", 30)
    rows = list(enumerate(["x" * 2000, *shared_passages(prose, 3, 30), "ab" * 700, "x" * 1000]))
    got = {r.doc_id: (bytes(r.kept), r.n_spans) for r in substrings.remove_repeats(documents(rows)).collect()}
    assert got == dict(enumerate(brute(rows)))


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=60, max_size=200), st.integers(0, 8), st.integers(0, 8))
def test_digests_tell_stretches(data, a, c):
    digests = substrings.Digests()
    b = np.frombuffer(b"zz" + data + b"q" * a + data + b"w" * c, dtype=np.uint8)
    n = len(data)
    starts, ends = np.array([2, 2 + n + a, 3, 2]), np.array([2 + n, 2 + 2 * n + a, 2 + n, 1 + n])
    one, two, three, four = digests.of(b, starts, ends, np.zeros(4, dtype=np.int64))
    assert one == two and len({int(one), int(three), int(four), int(digests.of(b, starts[:1], ends[:1], np.ones(1, dtype=np.int64))[0])}) == 3 + (data[1:] != data[:-1])


def test_columns_are_packed_whole():
    columns = [np.array([-1, 5]), np.array([0, (1 << 32) - 1]), np.array([1 << 32, 3]), np.array([2**63 - 1, -(2**63)])]
    assert all((a == b).all() for a, b in zip(columns, substrings.unpacked(substrings.packed(*columns))))
    assert [len(x) for x in substrings.unpacked(substrings.packed(*[c[:0] for c in columns]))] == [0] * 4


def test_repeated_and_missing_ids(documents, prose):
    text = prose(1, seed=6)[0]
    rows = [(5, text), (5, text), (5, text + " tail"), (None, text), (7, text), (1, None)]
    docs = documents(rows).selectExpr("*", "1 as text_key", "2 as spans", "3 as kept", "4 as hash")
    got = sorted((str(r.doc_id), bytes(r.kept).decode(), r.n_spans) for r in substrings.remove_repeats(docs).collect())
    assert got == sorted([("5", text, 0), ("5", text, 0), ("5", text + " tail", 0), ("None", text, 0), ("7", "", 1), ("1", "", 0)])
    assert substrings.remove_repeats(documents([])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=56, max_size=56).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=30), st.integers(0, 48))
def test_suffixes_group_by_prefix(strings, common):
    strings = [b"\x01" * common + s[common:] for s in strings]
    words = np.stack([np.frombuffer(s, dtype=">u8") for s in strings]).astype(np.uint64)
    members, number = substrings.equal_prefixes(words)
    got = {}
    for m, n in zip(members, number):
        got.setdefault(n, set()).add(int(m))
    want = {}
    for m, s in enumerate(strings):
        want.setdefault(s, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_a_frequent_anchor_is_sorted_a_few_places_at_a_time(monkeypatch):
    rng = np.random.default_rng(8)
    contexts = rng.integers(97, 123, (30_000, substrings.CONTEXT), dtype=np.uint8)
    contexts[20_000:] = contexts[:10_000]
    contexts[20_000:, :20] = 0
    docs = np.arange(len(contexts))
    lows, highs = np.zeros(len(contexts), dtype=np.int32), np.full(len(contexts), substrings.PLACES - 1, dtype=np.int32)
    tracemalloc.start()
    rows, start, end = substrings.covered(contexts, lows, highs, docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.tolist() == list(range(20_000, 30_000)) and (end == substrings.LEAST).all() and (start == -10).all()
    assert peak < 60 << 20
    monkeypatch.setattr(substrings, "HELD_STRINGS", 1 << 40)
    assert all((a == b).all() for a, b in zip((rows, start, end), substrings.covered(contexts, lows, highs, docs)))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=40), st.binary(min_size=50, max_size=70))
def test_equal_strings_share_an_anchor(before, after, passage):
    def by_start(text):
        found = {}
        for at, h in zip(*substrings.anchors(text)):
            for o in range(at >> 5 & 31, (at & 31) + 1):
                assert (at >> 10) - o not in found
                found[int(at >> 10) - o] = o, h
        assert sorted(found) == list(range(len(text) - 49))
        return found

    own, inside = by_start(passage), by_start(before + passage + after)
    assert all(inside[len(before) + start] == anchor for start, anchor in own.items())


def test_long_texts_are_read_in_parts(monkeypatch, prose):
    data = "\n".join(prose(30)).encode()
    whole = substrings.anchors(data)
    monkeypatch.setattr(substrings, "PART", 500)
    parts = substrings.anchors(data)
    starts = lambda found: sorted((int(at >> 10) - o, o, h) for at, h in zip(*found) for o in range(at >> 5 & 31, (at & 31) + 1))
    assert starts(whole) == starts(parts)
