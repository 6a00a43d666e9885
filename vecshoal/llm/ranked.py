"""Ranked lexical search, reversed: the items' terms are the index, and the documents stream through it.

1. Every item's distinct terms form an inverted index from term to items. It is sent to the tasks in blocks of at most
   ``block_bytes`` of terms (an item is never divided), so what is sent has a bound whatever the number of items.
2. Each document's terms are counted where it is read. Its length and its counts of indexed terms are stored; the number of
   documents, their total length and the document frequencies are summed from there.
3. The stored counts stream through the index with the terms' weights. A task keeps the ``k`` best documents of each item in a
   bounded heap; heaps are merged by item, first within shares of the tasks, then over all.

Terms are the longest runs of letters, digits and non-ASCII characters, with only A-Z lower-cased. All of a score but a term's weight is whole
numbers: a task's order of adding never matters.

Cases: a NULL, empty or term-free text counts neither as a document nor in the total length; texts of one item id are one item, whose
terms are those of all its texts; items without terms have no answers; a NULL item id is an item of its own; repeated documents are each
ranked; equal scores go by ascending document id, documents without an id last; empty tables give no rows. Document ids are whole
numbers. Other columns are not read, so they never clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vecshoal.llm.common import kept_at, whole

#: UTF-8 bytes outside terms become blanks, A-Z small letters.
FOLDED = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
LAST = np.iinfo(np.int64).max
SHARES = 256


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, term``, each once."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found = sorted(set(terms_of(batch.column(1)[at].as_py())))
                ids = pa.array([batch.column(0)[at].as_py()] * len(found), type=batch.column(0).type)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, type=pa.binary())], names=["item", "term"])

    rows = items.select(F.col(item_id).alias("item"), whole(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"item {kind}, term binary").distinct()


class Index:
    """Terms of a block of items, and the items of each term."""

    def __init__(self, rows: pa.Table):
        terms = rows["term"].combine_chunks().dictionary_encode()
        item = rows["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.items = item.dictionary  # with NULL as a value of its own
        self.numbers = {term: number for number, term in enumerate(terms.dictionary.to_pylist())}
        term, item = terms.indices.to_numpy(), item.indices.to_numpy()
        by_term = np.argsort(term, kind="stable")
        self.lengths = np.bincount(term, minlength=len(self.numbers))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.postings = item[by_term].astype(np.int64)


def counted(docs: DataFrame, numbers: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms, tf`` of every document with a term: its length, and the numbers and counts of its indexed terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.keys()
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                ids, sizes, terms, counts, ends = [], [], [], [], [0]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = terms_of(text)
                    if not found:
                        continue
                    of = Counter(found)
                    indexed = of.keys() & known
                    ids.append(doc)
                    sizes.append(len(found))
                    terms.extend(map(numbers.__getitem__, indexed))
                    counts.extend(map(of.__getitem__, indexed))
                    ends.append(len(terms))
                offsets = pa.array(ends, type=pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, type=pa.int32())) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, type=pa.int64()), pa.array(sizes, type=pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"]
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


class Heaps:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.zeros(items, dtype=np.int64)
        self.last = np.full(items, LAST)

    def update(self, scores: np.ndarray, docs: np.ndarray, named: np.ndarray) -> None:
        """``scores`` has a row for each document and a column for each item; a document without an id has the id LAST."""
        floor = self.least
        if len(docs) > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=0)[-self.k])
        better = (scores > self.least) | ((scores == self.least) & (docs[:, None] < self.last))
        for row, item in zip(*np.nonzero(better & (scores >= floor) & (scores > 0))):
            heap, entry = self.heaps[item], (int(scores[row, item]), -int(docs[row]), bool(named[row]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item], self.last[item] = heap[0][0], -heap[0][1]


def best_of_tasks(stored: DataFrame, index: Index, weights: np.ndarray, documents: int, total: int, k: int, kind: str, step: int = 2_000_000) -> DataFrame:
    """``item, doc_id, score, share``: each task's best documents of each item; ``step`` bounds the postings and scores held at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(index.items)
        heaps = Heaps(width, k)
        for batch in batches:
            n = batch.column("n").to_numpy()
            m = 100 - 90 + (90 * n * documents) // total
            ids = batch.column("doc_id")
            named, docs = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(int(LAST)).to_numpy()
            ends = batch.column("terms").offsets.to_numpy()
            terms, tf = batch.column("terms").flatten().to_numpy(), batch.column("tf").flatten().to_numpy().astype(np.int64)
            ends = ends - ends[0]
            doc = np.repeat(np.arange(len(n)), np.diff(ends))
            value = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            work = np.concatenate([[0], np.cumsum(index.lengths[terms])])[ends] + np.arange(len(ends)) * width
            begin = 0
            while begin < len(n):
                end = max(begin + 1, int(np.searchsorted(work, work[begin] + step, side="right")) - 1)
                some = slice(ends[begin], ends[end])
                many = index.lengths[terms[some]]
                of = np.repeat(np.arange(some.stop - some.start), many)
                place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(index.starts[terms[some]], many)
                cell = (doc[some][of] - begin) * width + index.postings[place]
                scores = np.zeros((end - begin) * width, dtype=np.int64)
                np.add.at(scores, cell, value[some][of])
                heaps.update(scores.reshape(end - begin, width), docs[begin:end], named[begin:end])
                begin = end
        found = [(item, None if not named else -doc, score) for item, heap in enumerate(heaps.heaps) for score, doc, named in heap]
        if found:
            item, doc, score = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [index.items.take(pa.array(item)), pa.array(doc, type=pa.int64()), pa.array(score, type=pa.int64()),
                 pa.array([TaskContext.get().partitionId() % SHARES] * len(found), type=pa.int32())],
                names=["item", "doc_id", "score", "share"],
            )

    return stored.mapInArrow(run, f"item {kind}, doc_id long, score long, share int")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    kind = items.schema[item_id].dataType.simpleString()
    terms, _ = kept_at(item_terms(items, item_id, item_text), "item-terms")
    size = terms.agg(F.sum(F.length("term") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    parts = []
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else terms
        index = Index(own.toArrow())
        stored, _ = kept_at(counted(docs, index.numbers, doc_id, text), "term-counts")
        documents, total = stored.agg(F.count("*"), F.sum("n")).first()
        frequencies = stored.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(index.numbers), dtype=np.int64)
        df[frequencies["term"].to_numpy()] = frequencies["count"].to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        parts.append(best_of_tasks(stored, index, weights, documents, max(total or 0, 1), k, kind))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("item", "share").orderBy(*best))).where(F.col("place") <= k)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
