"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, their weights ``1 + ln(count)``. For each of ``samples`` hash functions every term draws
``r, c`` from Gamma(2, 1) and ``b`` from U(0, 1), seeded by the term alone; with ``t = floor(ln w / r + b)`` the term with the
least ``c / exp(r (t - b) + r)`` is sampled, together with ``t``. Two texts take the same sample with a chance equal to
their generalised Jaccard similarity, the sum of the lesser weights over that of the greater. A fingerprint keeps 16 bits of each
sample, in hexadecimal; the likeness of two is the share of equal samples.

:func:`with_next` puts beside each document the one that follows it by descending id, without a global sort in one task: ids are cut into
ranges at quantiles of all ids, each range is sorted in its own partition, and the first document of a range
is also sent to the range that it follows.

Cases: a NULL or empty text has no terms and its own fingerprint (like itself 1, any other 0); equal texts have equal
fingerprints; among rows with one id the order is that of their texts' hashes; rows without an id stand in no order and are followed by an
empty text; an empty table gives an empty result. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.llm.common import text_key, whole

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def uniforms(seeds: np.ndarray, draws: int) -> np.ndarray:
    """``draws`` numbers in (0, 1) for each 64-bit seed."""
    x = seeds[:, None] + GOLDEN * np.arange(1, draws + 1, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)


class Sampler:
    """Fingerprints of texts; the draws of up to ``remember`` terms are kept for the next texts."""

    def __init__(self, samples: int = 64, remember: int = 60_000):
        self.samples, self.remember = samples, remember
        self.row: dict[str, int] = {}
        self.hash = np.zeros(remember, dtype=np.uint64)
        self.r, self.b, self.ln_c = (np.zeros((remember, samples), dtype=np.float32) for _ in range(3))

    def draw(self, terms: list[str]) -> tuple[np.ndarray, ...]:
        k = self.samples
        seeds = np.fromiter((xxhash.xxh64_intdigest(term) for term in terms), dtype=np.uint64, count=len(terms))
        u = uniforms(seeds, 5 * k)
        r = -np.log(u[:, :k] * u[:, k : 2 * k])
        ln_c = np.log(-np.log(u[:, 2 * k : 3 * k] * u[:, 3 * k : 4 * k]))
        return seeds, r, u[:, 4 * k :], ln_c

    def lookup(self, terms: list[str]) -> tuple[np.ndarray, ...]:
        if len(terms) > self.remember // 2:  # more than the memory is for: drawn and dropped
            return self.draw(terms)
        new = [term for term in terms if term not in self.row]
        if len(self.row) + len(new) > self.remember:
            self.row, new = {}, terms
        if new:
            first = len(self.row)
            at = slice(first, first + len(new))
            self.hash[at], self.r[at], self.b[at], self.ln_c[at] = self.draw(new)
            self.row.update(zip(new, range(first, first + len(new))))
        rows = np.fromiter(map(self.row.__getitem__, terms), dtype=np.int64, count=len(terms))
        return self.hash[rows], self.r[rows], self.b[rows], self.ln_c[rows]

    def __call__(self, text: str) -> np.ndarray:
        """One 16-bit number per sample; none for a text without words."""
        counts = Counter(text.split())
        if not counts:
            return np.zeros(0, dtype=np.uint16)
        ln_w = np.log1p(np.log(np.fromiter(counts.values(), dtype=np.float32, count=len(counts))))
        terms = list(counts)
        best, codes = None, None
        for at in range(0, len(terms), 8192):
            hashes, r, b, ln_c = self.lookup(terms[at : at + 8192])
            t = np.floor(ln_w[at : at + 8192, None] / r + b)
            ln_a = ln_c - r * (t - b + 1)
            least = ln_a.argmin(axis=0)
            across = np.arange(self.samples)
            value, taken = ln_a[least, across], t[least, across].astype(np.int64).astype(np.uint64)
            code = ((hashes[least] ^ (taken * GOLDEN)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)
            if best is None:
                best, codes = value, code
            else:
                better = value < best
                best, codes = np.where(better, value, best), np.where(better, code, codes)
        return codes.astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples."""
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean()) if len(a) else 1.0


def as_text(codes: np.ndarray) -> str:
    return codes.astype(">u2").tobytes().hex()


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = 64) -> DataFrame:
    """``doc_id, fingerprint`` of each document."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sampler = Sampler(samples)
        for batch in batches:
            yield pa.array([as_text(sampler(one.as_py())) for one in batch], type=pa.string())

    return docs.select(F.col(doc_id).alias("doc_id"), run(whole(text)).alias("fingerprint"))


def with_next(docs: DataFrame, doc_id: str, text: str, rows_per_range: int, most_ranges: int) -> DataFrame:
    """Rows ``range, sent, doc_id, text`` in partitions by range, sorted by descending id; ``sent`` marks the row that follows a range's last."""
    ids = docs.select(F.col(doc_id).alias("doc_id"))
    rows, top = ids.agg(F.count("doc_id"), F.max("doc_id")).first()
    ranges = max(1, min(most_ranges, rows // rows_per_range))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] if shares else []
    ends = np.array(sorted({*(cuts or []), *([] if top is None else [top])}), dtype=np.int64)

    @F.arrow_udf("array<int>")
    def ranges_of(column: pa.Array) -> pa.Array:
        values = column.to_numpy(zero_copy_only=False)
        own = np.searchsorted(ends, values)
        is_end = ends[np.minimum(own, len(ends) - 1)] == values
        after = np.where(own + 1 < len(ends), own + 1, 0)
        return pa.array([[int(a), int(b) + len(ends)] if e else [int(a)] for a, b, e in zip(own, after, is_end)], type=pa.list_(pa.int32()))

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    placed = rows.where(F.col("doc_id").isNotNull()).withColumn("_to", F.explode(ranges_of("doc_id")))
    placed = placed.select(
        F.pmod("_to", F.lit(max(1, len(ends)))).alias("range"), (F.col("_to") >= len(ends)).alias("sent"), "doc_id", "text"
    )
    nameless = rows.where(F.col("doc_id").isNull()).select(
        (-1 - F.pmod(text_key(F.col("text")), F.lit(ranges))).cast("int").alias("range"), F.lit(False).alias("sent"), "doc_id", "text"
    )
    return (
        placed.unionByName(nameless)
        .repartition(max(1, len(ends)), "range")
        .sortWithinPartitions("range", "sent", F.col("doc_id").desc(), text_key(F.col("text")))
    )


def compare_edited(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    samples: int = 64,
    rows_per_range: int = 4_000,
    most_ranges: int = 10_000,
) -> DataFrame:
    """Fingerprints of each document and of its edited text, and the likeness of the first to the second and to the next document's.

    The edited text has its last third replaced by as many code points, from the start, of the next document by descending id; after
    the last comes the first.
    """
    ordered = with_next(docs, doc_id, text, rows_per_range, most_ranges)
    schema = T.StructType(
        [
            T.StructField("doc_id", ordered.schema["doc_id"].dataType),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        before: tuple | None = None

        def told(row: tuple, following: str, codes: np.ndarray) -> tuple:
            _, doc, text, own = row
            cut = len(text) // 3
            edited = text[: len(text) - cut] + following[:cut]
            other = own if edited == text else sampler(edited)
            sha = hashlib.sha256(edited.encode()).hexdigest()
            return doc, len(text), sha, as_text(own), as_text(other), likeness(own, other), likeness(own, codes)

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal before
            for at, sent, doc, text in zip(*(column.to_pylist() for column in batch.columns)):
                if before is not None and before[0] != at:
                    # Only a range of rows without ids ends without a sent row.
                    yield told(before, "", sampler(""))
                    before = None
                if before is None and sent:
                    continue
                codes = sampler(text)
                if before is not None:
                    yield told(before, "", sampler("")) if at < 0 else told(before, text, codes)
                before = None if sent else (at, doc, text, codes)

        def packed(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, type=kind) for column, kind in zip(zip(*found), kinds)], names=schema.names)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                if found := list(rows(batch.slice(at, 512))):
                    yield packed(found)
        if before is not None:
            yield packed([told(before, "", sampler(""))])

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return ordered.mapInArrow(run, schema)
