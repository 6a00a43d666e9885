"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters and digits or runs of other signs. A word in capitals counts as its lower-case
form with a mark, and a word that repeats the one before it as a sign of its own, so that both habits carry over to words
never seen. One- and two-word grams are hashed into ``2**bits`` slots; a document is the unit vector
of its gram counts, and its score one sparse dot product.

The model is fitted on a bounded sample of labelled rows (``max_rows``, chosen by a hash of the id), dealt to
``shards`` groups. Each group runs the leader updates on its own rows and the weights are averaged, so what
reaches the driver is one weight per slot.

Cases: a NULL or empty text has no grams and gets the score of the intercept; ties do not arise; repeated rows are
scored alike; labels without a value are left out, of several for one id the lowest counts; without any usable label
all scores are 0.5. Of the input only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import whole

WORD = re.compile(r"\w+|[^\w\s]+")


class Grams:
    """Hashed one- and two-word grams of texts, with a bounded memory of words and their hashes."""

    def __init__(self, bits: int, remember: int = 300_000):
        self.shift = np.uint64(64 - bits)
        self.remember = remember
        self.known: dict[str, bytes] = {}

    def numbers(self, chunk: str) -> bytes:
        """The hashes of the words in a chunk without blanks."""
        out = []
        for word in WORD.findall(chunk):
            plain = "\x01" + word.lower() if len(word) > 1 and word.isupper() else word.lower()
            out.append(xxhash.xxh64_intdigest(plain))
        return np.array(out, dtype=np.uint64).tobytes()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Slots and values of a text; the values have length 1."""
        chunks = text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")
        known = self.known
        if len(known) > self.remember:
            known.clear()
        for chunk in set(chunks).difference(known):
            known[chunk] = self.numbers(chunk)
        single = np.frombuffer(b"".join(map(known.__getitem__, chunks)), dtype=np.uint64).copy()
        if not len(single):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        single[np.flatnonzero(single[1:] == single[:-1]) + 1] = 7
        double = (single[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ single[1:]
        grams = np.concatenate([single, double]) * np.uint64(0xD6E8FEB86659FD93)
        slots, counts = np.unique((grams >> self.shift).astype(np.int64), return_counts=True)
        return slots, counts / np.sqrt((counts * counts).sum())


@dataclass
class Leader:
    """Per-coordinate follow-the-regularised-leader for logistic loss; the last slot is the intercept."""

    slots: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02

    def __post_init__(self):
        self.z = np.zeros(self.slots + 1)
        self.n = np.zeros(self.slots + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        at, x = np.append(slots, self.slots), np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g


@dataclass(frozen=True)
class QualityModel:
    """One weight per slot, and the intercept."""

    weights: np.ndarray
    intercept: float
    bits: int

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
        """``doc_id`` (and the columns ``keep``) with ``score``, the chance of label 1."""
        model = docs.sparkSession.sparkContext.broadcast((self.weights.astype(np.float32), self.intercept))
        bits = self.bits

        @F.arrow_udf("double")
        def chance(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            weights, intercept = model.value
            grams = Grams(bits)
            for batch in batches:
                out = np.empty(len(batch))
                for row, one in enumerate(batch):
                    slots, values = grams(one.as_py() or "")
                    out[row] = intercept + weights[slots] @ values
                yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

        kept = [F.col(name) for name in dict.fromkeys((doc_id, *keep)) if name != "score"]
        return docs.select(*kept, chance(whole(text)).alias("score"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, doc_id: str, text: str) -> DataFrame:
    """About ``max_rows`` labelled documents at most, chosen by a hash of the id: ``_id, _text, _label``."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("double").alias("_label"))
    share = max_rows / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(doc_id).alias("_id"), whole(text).alias("_text"))
    return texts.join(F.broadcast(known), "_id")


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    bits: int = 18,
    max_rows: int = 12_000,
    shards: int = 6,
    epochs: int = 4,
) -> QualityModel:
    """Fit on at most about ``max_rows`` of the rows of ``labels`` that ``docs`` has."""
    sample = labelled_sample(docs, labels, label, max_rows, doc_id, text)
    dealt = sample.withColumn("_shard", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(shards)).cast("int"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "_text"])
        grams, leader = Grams(bits), Leader(1 << bits)
        vectors = [grams(text) for text in rows["_text"]]
        truth = rows["_label"].to_numpy()
        order = np.random.default_rng(0)
        for _ in range(epochs):
            for row in order.permutation(len(rows)):
                leader.learn(*vectors[row], truth[row])
        weights = leader.weights(np.arange((1 << bits) + 1))
        # The intercept always goes out, so that the number of shards can be told.
        used = np.flatnonzero(weights[:-1])
        used = np.append(used, 1 << bits)
        return pd.DataFrame({"slot": used, "weight": weights[used]})

    fitted = dealt.groupBy("_shard").applyInPandas(fit, "slot long, weight double")
    summed = fitted.groupBy("slot").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).toPandas()
    weights = np.zeros((1 << bits) + 1)
    if len(summed):
        weights[summed["slot"]] = summed["weight"] / summed["n"].max()
    return QualityModel(weights[:-1], float(weights[-1]), bits)
