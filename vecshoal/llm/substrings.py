"""Removing passages that repeat across documents, by sorting suffixes.

A byte goes if a string of ``least`` bytes (50) that covers it also starts in a document with a smaller id. All suffixes of a
corpus are too many to move, so only those that can repeat are sorted:

1. Anchors: of every 50-byte string the 20-byte string in it with the least hash is taken, so that equal strings have equal anchors, at
   equal places. The bytes around an anchor, of all the 50-byte strings that it was taken from, are its context, told by a digest.
   Anchors are summed up by hash, within tasks first: their least and greatest document, and whether their contexts differ. They travel as
   packed columns, dealt into buckets by hash.
2. All anchors meet these sums again, bucket by bucket. Those of one document go; where all contexts of an anchor are equal, they repeat
   in every document but the first, and nothing needs sorting. Buckets with very frequent anchors are dealt in parts.
3. The contexts of the other anchors are read from the texts, dealt by anchor, and their suffixes sorted from shallow to deep: by
   eight-byte words to depth 24, and what is then still in groups has a long common prefix and goes straight to the first word in which the
   group differs, as in a blind trie. Sorts of whole columns by word stand for the quicksort of single suffixes.
   Suffixes equal over 50 bytes end side by side, and the least id among them tells for which documents they repeat.
4. The spans found are merged by document and cut out; one found by digest is cut where the text has the bytes of the digest.

An anchor with more than ``most_contexts`` occurrences and differing contexts is not gathered in one task: its strings are grouped by content with DataFrame
functions instead, with partial aggregation and a join whose large partitions Spark splits. The result is the same.

Cases: a NULL or empty text, or one under 50 bytes, has nothing to remove; documents without an id neither lose bytes nor
make others lose any; rows of one id do not count against each other, and equal rows come out alike; an empty table gives an empty
result. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import kept_at, stored, text_key, whole
from vecshoal.session import remove_path

LEAST = 50
ANCHOR = 20
#: Anchors in a string of LEAST bytes, and so the strings that hold one anchor.
PLACES = LEAST - ANCHOR + 1
BEFORE = LEAST - ANCHOR
CONTEXT = BEFORE + LEAST
#: Bytes of text for each bucket of anchors, anchors that a task sums up or deals at a time, and occurrences for each part of a bucket.
BUCKET_BYTES = 4 << 20
HELD_ANCHORS = 500_000
PART_ANCHORS = 2_000_000
#: Strings that a task sorts at a time, or as many as there are contexts.
HELD_STRINGS = 100_000
SHALLOW_WORDS = 3
PART = 1 << 20
PLACE_BITS = np.uint64((1 << 21) - 1)
ODD_NUMBER = 0x9E3779B97F4A7C15


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


class Digests:
    """64-bit digests of stretches of a text: sums of a number for each byte times powers of an odd number, from running sums."""

    def __init__(self):
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD_NUMBER)
        self.of_byte = mixed(x)
        self.grow(1 << 12)

    def grow(self, size: int) -> None:
        inverse = np.uint64(pow(ODD_NUMBER, -1, 1 << 64))
        self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, ODD_NUMBER, dtype=np.uint64))])
        self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, inverse))])

    def of(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Digests of the stretches from ``starts`` to ``ends`` of the bytes ``b``, each with a small number of its own."""
        if len(b) >= len(self.up):
            self.grow(2 * len(b))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.of_byte[b] * self.down[: len(b)])])
        return mixed((sums[ends] - sums[starts]) * self.up[starts] + (ends - starts << 10 | extra).astype(np.uint64)).view(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def anchors(text: bytes, digests: Digests | None = None) -> tuple[np.ndarray, ...]:
    """Anchors of a text: ``place << 10 | o_low << 5 | o_high``, their hashes, and the digests of their contexts if asked for.

    The strings that an anchor stands for, those in which it is the first of least hash, start ``o_low`` to ``o_high`` bytes before it;
    every string has one anchor.
    """
    nothing = np.zeros(0, dtype=np.int64)
    found, hashes, told = [nothing], [nothing], [nothing]
    for begin in range(0, len(text) - LEAST + 1, PART):
        b = np.frombuffer(text, dtype=np.uint8, offset=begin, count=min(PART + LEAST - 1, len(text) - begin))
        h, by_size = b.astype(np.uint64) + np.uint64(1), {}
        for size in (1, 2, 4, 8):
            by_size[size] = h
            h = h[:-size] * np.uint64(pow(ODD_NUMBER, size, 1 << 64)) + h[size:]
        h = h[: len(h) - 4] * np.uint64(ODD_NUMBER) + by_size[4][16:]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        # The place in the low bits: of equal hashes the first is the least.
        ranked = (h & ~PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        least = (sliding(ranked, PLACES, np.minimum) & PLACE_BITS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        at, last = least[first], np.append(first[1:], len(least)) - 1
        found.append((at + begin) << 10 | (at - last) << 5 | at - first)
        hashes.append(h[at].view(np.int64))
        if digests is not None:
            told.append(digests.of(b, first, last + LEAST, (at - last) << 5 | at - first))
    out = np.concatenate(found), np.concatenate(hashes)
    return out if digests is None else (*out, np.concatenate(told))


def refine(order: np.ndarray, runs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the members of each run by their key and split runs where it changes; singles drop out.

    ``order`` holds suffix numbers, ``runs`` their ascending run numbers.
    """
    by = np.lexsort((keys, runs))
    order, runs, keys = order[by], runs[by], keys[by]
    new = np.concatenate([[True], (runs[1:] != runs[:-1]) | (keys[1:] != keys[:-1])])
    number = np.cumsum(new) - 1
    many = np.bincount(number)[number] > 1
    return order[many], number[many]


def equal_prefixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that are not alone with their prefix, and the number of the prefix; ``words`` holds a row of 8-byte words for each."""
    order, runs = np.arange(len(words)), np.zeros(len(words), dtype=np.int64)
    for depth in range(SHALLOW_WORDS):
        if len(order):
            order, runs = refine(order, runs, words[order, depth])
    finished, number = [order[:0]], [runs[:0]]
    count = 0
    while len(order):
        starts = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
        deep = words[order, SHALLOW_WORDS:]
        differ = np.minimum.reduceat(deep, starts, axis=0) != np.maximum.reduceat(deep, starts, axis=0)
        sizes = np.diff(np.append(starts, len(order)))
        done = np.repeat(~differ.any(axis=1), sizes)
        finished.append(order[done])
        _, label = np.unique(runs[done], return_inverse=True)
        number.append(label + count)
        count += int(label.max()) + 1 if len(label) else 0
        branch = np.repeat(differ.argmax(axis=1), sizes)[~done]
        order, runs = order[~done], runs[~done]
        if len(order):
            order, runs = refine(order, runs, words[order, SHALLOW_WORDS + branch])
    return np.concatenate(finished), np.concatenate(number)


def covered(contexts: np.ndarray, lows: np.ndarray, highs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose context repeats an earlier document, with the first and last byte (exclusive) relative to the anchor.

    ``lows`` and ``highs`` say how far before the anchor its strings start.
    """
    packed = np.concatenate([contexts, lows[:, None].astype(np.uint8), highs[:, None].astype(np.uint8)], axis=1)
    flat = np.ascontiguousarray(packed).view(np.dtype((np.void, packed.shape[1]))).ravel()
    _, kept, same = np.unique(flat, return_index=True, return_inverse=True)
    same = same.ravel()
    first = np.full(len(kept), np.iinfo(np.int64).max)
    np.minimum.at(first, same, docs)
    u, low, high = contexts[kept], lows[kept][:, None], highs[kept][:, None]
    windows = np.lib.stride_tricks.sliding_window_view(u, LEAST, axis=1)
    repeats = np.zeros((len(docs), PLACES), dtype=bool)
    # Equal strings have their anchor at equal places, so a few places are sorted at a time.
    step = max(1, HELD_STRINGS // max(1, len(u)))
    for begin in range(0, PLACES, step):
        # Place o: the string starts o bytes before the anchor.
        o = np.arange(begin, min(begin + step, PLACES))
        real = (o >= low) & (o <= high)
        row, place = np.nonzero(real)
        strings = windows[row, BEFORE - o[place]]
        words = np.concatenate([strings[:, : LEAST // 8 * 8], strings[:, LEAST - 8 :]], axis=1).view(">u8").astype(np.uint64)
        least = np.where(real, first[:, None], np.iinfo(np.int64).max)
        members, number = equal_prefixes(words)
        if len(members):
            earliest = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(earliest, number, first[row[members]])
            least[row[members], place[members]] = earliest[number]
        repeats[:, o] = least[same] < docs[:, None]
    rows = np.flatnonzero(repeats.any(axis=1))
    repeats = repeats[rows]
    nearest, farthest = repeats.argmax(axis=1), PLACES - 1 - repeats[:, ::-1].argmax(axis=1)
    return rows, -farthest, LEAST - nearest


def same_digests(data: bytes, starts: np.ndarray, ends: np.ndarray, extra: np.ndarray, told: np.ndarray, digests: Digests) -> np.ndarray:
    """Whether the text has the digests ``told`` in these spans."""
    out = np.zeros(len(starts), dtype=bool)
    for begin in range(0, len(data), PART):
        here = np.flatnonzero((starts >= begin) & (starts < begin + PART) & (ends <= len(data)))
        if len(here):
            b = np.frombuffer(data, dtype=np.uint8, offset=begin, count=min(PART + CONTEXT, len(data) - begin))
            out[here] = digests.of(b, starts[here] - begin, ends[here] - begin, extra[here]) == told[here]
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as bytes; those that fit are kept in four bytes a number."""
    out = [np.array([len(columns), len(columns[0])], dtype="<u4").tobytes()]
    for column in columns:
        small = len(column) > 0 and 0 <= column.min() and column.max() < 1 << 32
        out += [b"4" if small else b"8", column.astype("<u4" if small else "<i8").tobytes()]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    count, size = np.frombuffer(data, dtype="<u4", count=2)
    out, at = [], 8
    for _ in range(count):
        small = data[at : at + 1] == b"4"
        out.append(np.frombuffer(data, dtype="<u4" if small else "<i8", offset=at + 1, count=size).astype(np.int64))
        at += 1 + int(size) * (4 if small else 8)
    return out


def anchors_held(batches: Iterator[pa.RecordBatch], with_digests: bool, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``hash, doc, at`` and the digest of the anchors of the rows ``doc_id, text``, ``most`` or a text's more at a time."""
    digests = Digests() if with_digests else None
    held, count = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            at, hashes, *told = anchors(text.as_buffer().to_pybytes(), digests)
            if len(at):
                held.append((hashes, np.full(len(at), doc), at, *told))
                count += len(at)
            if count > most:
                yield tuple(map(np.concatenate, zip(*held)))
                held, count = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(1)) % np.uint64(buckets)


def by_bucket(hashes: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns split by bucket; in a bucket in the order that they come."""
    bucket = bucket_of(hashes, buckets).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    numbers, starts = np.unique(bucket[order], return_index=True)
    for number, start, end in zip(numbers.tolist(), starts, np.append(starts[1:], len(order))):
        yield number, [column[order[start:end]] for column in (hashes, *columns)]


def summed(hashes, digests, least, most, counts, differ) -> tuple[np.ndarray, ...]:
    """One row for each hash: a digest, least and greatest document, occurrences, and whether digests differ."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    low, high = (pick.reduceat(digests[order], starts) for pick in (np.minimum, np.maximum))
    differ = np.maximum.reduceat(differ[order], starts) | (low != high)
    return hashes[starts], low, np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts), np.add.reduceat(counts[order], starts), differ


def anchor_sums(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, sums``: the anchors of a task's rows, one row each; those met once are packed apart, as three columns do for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, doc, _, told in anchors_held(batches, True, HELD_ANCHORS):
            sums = summed(hashes, told, doc, doc, np.ones(len(doc), dtype=np.int64), np.zeros(len(doc), dtype=np.int64))
            rows = []
            for bucket, (hashes, told, least, most, counts, differ) in by_bucket(sums[0], buckets, *sums[1:]):
                once = counts == 1
                again = [x[~once] for x in (hashes, told, least, most, counts, differ)]
                rows.append((bucket, packed(hashes[once], told[once], least[once]), packed(*again)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], type=pa.int64()), *(pa.array(c, type=pa.binary()) for c in columns[1:])], names=["bucket", "once", "again"])

    return docs.mapInArrow(run, "bucket long, once binary, again binary")


def by_turns(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows in groups of equal first ``keys`` columns, which follow one another."""
    rows = (tuple(column[n].as_py() for column in batch.columns) for batch in batches for n in range(batch.num_rows))
    return itertools.groupby(rows, key=lambda row: row[:keys])


def shared_anchors(sums: DataFrame, most_contexts: int) -> DataFrame:
    """``bucket, parts, shared``: of the anchors that two documents have, hash, digest, least document and kind, sorted by hash.

    The kind is 0 if all contexts are equal, else 1, or 2 with over ``most_contexts`` occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in by_turns(batches, 1):
            held, waiting, total = None, [], 0

            def merge() -> None:
                nonlocal held, waiting
                held, waiting = summed(*map(np.concatenate, zip(*([held] if held else []), *waiting))), []

            for _, once, again in rows:
                hashes, told, doc = unpacked(once)
                ones = np.ones(len(doc), dtype=np.int64)
                waiting += [(hashes, told, doc, doc, ones, ones * 0), tuple(unpacked(again))]
                total += len(doc) + int(waiting[-1][4].sum())
                if sum(len(x[0]) for x in waiting) > 4 * HELD_ANCHORS:
                    merge()
            merge()
            hashes, told, least, most, counts, differ = held
            kind = differ * (1 + (counts > most_contexts))
            shared = packed(*(x[least < most] for x in (hashes, told, least, kind)))
            columns = [pa.array([bucket], type=pa.int64()), pa.array([1 + total // PART_ANCHORS], type=pa.int32()), pa.array([shared], type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "parts", "shared"])

    return sums.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket long, parts int, shared binary")


def anchor_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, draw, found``: the hashes, documents and places of all anchors of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (hashes, doc, at) in enumerate(anchors_held(batches, False, HELD_ANCHORS), TaskContext.get().partitionId()):
            rows = [(bucket, number, packed(*columns)) for bucket, columns in by_bucket(hashes, buckets, doc, at)]
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "draw", "found"])

    return docs.mapInArrow(run, "bucket long, draw int, found binary")


def told_apart(found: DataFrame, shared: DataFrame) -> DataFrame:
    """``doc_id, at, told, kind`` of the shared anchors found: the hash, or the digest of a context that repeats as it is (kind 0).

    The shared anchors of a bucket come before what was found; frequent buckets are dealt in parts, each with all of the former.
    """
    several = shared.where("parts > 1").select("bucket", "parts")
    dealt = found.join(several, "bucket", "left").select("bucket", F.pmod("draw", F.coalesce("parts", F.lit(1))).alias("part"), F.lit(1).alias("turn"), F.col("found").alias("data"))
    every = shared.select("bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("turn"), F.col("shared").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_turns(batches, 2):
            hashes = np.zeros(0, dtype=np.int64)
            for _, _, turn, data in rows:
                if turn == 0:
                    hashes, told, least, kind = unpacked(data)
                    continue
                if not len(hashes):
                    continue
                own, doc, at = unpacked(data)
                place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                met = hashes[place] == own
                met &= (kind[place] > 0) | (least[place] < doc)
                place = place[met]
                for begin in range(0, len(place), 100_000):
                    some, end = place[begin : begin + 100_000], begin + 100_000
                    columns = [doc[met][begin:end], at[met][begin:end], np.where(kind[some] > 0, hashes[some], told[some]), kind[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "at", "told", "kind"])

    keys = ["bucket", "part"]
    met = dealt.unionByName(every).repartition(*keys).sortWithinPartitions(*keys, "turn").select("bucket", "part", "turn", "data")
    return met.mapInArrow(run, "doc_id long, at long, told long, kind long")


def context_rows(docs: DataFrame, hints: DataFrame) -> DataFrame:
    """Contexts of the anchors in ``hints``, which has an array of places and hashes for each ``doc_id``.

    Of a context only the bytes of the strings that the anchor stands for are there, the others are 0.
    """
    reach = np.arange(CONTEXT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "doc_id", "text_key", "pos", "low", "high", "context"]
        for batch in batches:
            for doc, key, text, listed in zip(*(batch.column(n) for n in range(4))):
                data, places = text.as_py(), listed.values
                at, hashes = (places.field(n).to_numpy(zero_copy_only=False) for n in range(2))
                pos, low, high = at >> 10, at >> 5 & 31, at & 31
                # Rows of one id may have other texts, whose anchors mean nothing here.
                inside = np.flatnonzero(pos - low + LEAST <= len(data))
                padded = np.zeros(len(data) + CONTEXT, dtype=np.uint8)
                padded[BEFORE : BEFORE + len(data)] = np.frombuffer(data, dtype=np.uint8)
                for begin in range(0, len(inside), 20_000):
                    some = inside[begin : begin + 20_000]
                    windows = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[pos[some]]
                    used = (reach >= BEFORE - high[some][:, None]) & (reach < CONTEXT - low[some][:, None])
                    offsets = np.arange(0, CONTEXT * (len(some) + 1), CONTEXT, dtype=np.int32)
                    buffers = [None, pa.py_buffer(offsets), pa.py_buffer((windows * used).tobytes())]
                    columns = [
                        pa.array(hashes[some]), pa.array(np.full(len(some), doc.as_py())), pa.array(np.full(len(some), key.as_py())),
                        *(pa.array(x[some].astype(np.int32)) for x in (pos, low, high)),
                        pa.Array.from_buffers(pa.binary(), len(some), buffers),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "hash long, doc_id long, text_key long, pos int, low int, high int, context binary"
    rows = docs.select("doc_id", text_key(F.col("_text")).alias("text_key"), F.col("_text").cast("binary").alias("_bytes"))
    return rows.join(hints, "doc_id").select("doc_id", "text_key", "_bytes", "at").mapInArrow(run, schema)


def repeats_by_sorting(contexts: DataFrame) -> DataFrame:
    """``doc_id, text_key, start, end`` of what repeats, from contexts dealt by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "start", "end"]

        def found(table: pa.Table) -> pa.RecordBatch:
            column = lambda name: table[name].to_numpy()
            raw = table["context"].combine_chunks()
            raw = pa.concat_arrays(raw.chunks) if isinstance(raw, pa.ChunkedArray) else raw
            bytes_ = np.frombuffer(b"".join(raw.to_pylist()), dtype=np.uint8).reshape(-1, CONTEXT)
            docs, pos = column("doc_id"), column("pos").astype(np.int64)
            rows, start, end = covered(bytes_, column("low"), column("high"), docs)
            columns = [docs[rows], column("text_key")[rows], pos[rows] + start, pos[rows] + end]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = batch.column(0).to_numpy()
            last = int(np.searchsorted(hashes, hashes[-1]))  # rows of the last anchor may go on in the next batch
            if last or (held and held[-1].column(0)[-1].as_py() != hashes[0]):
                done = [*held, batch.slice(0, last)]
                held = []
                if sum(b.num_rows for b in done):
                    yield found(pa.Table.from_batches(done))
            held.append(batch.slice(last))
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = contexts.repartition("hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(run, "doc_id long, text_key long, start long, end long")


def repeats_by_content(contexts: DataFrame) -> DataFrame:
    """The same for anchors too frequent for one task: their strings are grouped by content."""
    strings = contexts.select("doc_id", "text_key", "pos", "context", F.explode(F.sequence("low", "high")).alias("o"))
    strings = strings.withColumn("string", F.expr(f"substring(context, {BEFORE + 1} - o, {LEAST})")).drop("context")
    earliest = strings.groupBy("string").agg(F.min("doc_id").alias("earliest"))
    later = strings.join(earliest, "string").where(F.col("earliest") < F.col("doc_id"))
    start = F.col("pos").cast("long") - F.col("o")
    return later.select("doc_id", "text_key", start.alias("start"), (start + LEAST).alias("end"))


def hints_of(kind: int, name: str) -> Column:
    """The anchors of a document that are of a kind."""
    return F.collect_list(F.when(F.col("kind") == kind, F.struct("at", F.col("told").alias("hash")))).alias(name)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_contexts: int = 100_000) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept``, the bytes left of each document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("_text"))
    named = rows.where(F.col("doc_id").isNotNull())
    texts = named.select("doc_id", F.col("_text").cast("binary"))
    size = named.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    shared, shared_path = kept_at(shared_anchors(anchor_sums(texts, buckets), most_contexts), "anchors")
    told, told_path = kept_at(told_apart(anchor_rows(texts, buckets), shared), "told")
    remove_path(spark, shared_path)
    differing = told.where("kind > 0").groupBy("doc_id").agg(hints_of(1, "seldom"), hints_of(2, "often"))
    # Stored, so that the documents' shuffle is freed before the contexts' own.
    contexts, contexts_path = kept_at(context_rows(named, differing.select("doc_id", F.col("seldom").alias("at"))), "contexts")
    spans = repeats_by_sorting(contexts)
    if not told.where("kind = 2").isEmpty():
        often = differing.where(F.size("often") > 0).select("doc_id", F.col("often").alias("at"))
        spans = spans.unionByName(repeats_by_content(context_rows(named, often)))
    low, high = (F.shiftright("at", bits).bitwiseAND(31) for bits in (5, 0))
    place = F.shiftright("at", 10)
    same = told.where("kind = 0").select(
        "doc_id", F.lit(None).cast("long").alias("text_key"), (place - high).alias("start"), (place - low + LEAST).alias("end"),
        F.col("at").bitwiseAND(1023).alias("extra"), F.col("told").alias("digest"),
    )
    spans = spans.withColumns({"extra": F.lit(0).cast("long"), "digest": F.lit(None).cast("long")}).unionByName(same)
    spans = stored(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "extra", "text_key", "digest")).alias("spans")), "spans")
    remove_path(spark, contexts_path)
    remove_path(spark, told_path)

    def runs_of(data: bytes, key: int, spans: pa.StructScalar, digests: Digests) -> list[tuple[int, int]]:
        """The spans that mean this text, and not another of the same id, merged."""
        start, end, extra = (spans.values.field(n).to_numpy() for n in range(3))
        keys, told = spans.values.field(3), spans.values.field(4)
        mine = keys.fill_null(key).to_numpy() == key
        some = np.flatnonzero(told.is_valid().to_numpy(zero_copy_only=False))
        if len(some):
            mine[some] = same_digests(data, start[some], end[some], extra[some], told.take(pa.array(some)).to_numpy(), digests)
        return merged(list(zip(start[mine].tolist(), end[mine].tolist())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for data, key, found in zip(part.column(1), part.column(2).to_pylist(), part.column(3)):
                    data = data.as_py()
                    runs = runs_of(data, key, found, digests) if found.is_valid else []
                    ends = [0, *(end for _, end in runs)]
                    starts = [*(start for start, _ in runs), len(data)]
                    kept = b"".join(data[end:start] for end, start in zip(ends, starts)) if runs else data
                    out.append((len(data), len(data) - len(kept), len(runs), kept))
                columns = [pa.array(c, type=k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    keyed = rows.withColumn("text_key", text_key(F.col("_text")))
    joined = keyed.join(spans, "doc_id", "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.select("doc_id", F.col("_text").cast("binary"), "text_key", "spans").mapInArrow(cut, schema)
