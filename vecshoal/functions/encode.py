"""Text to vectors through a pluggable encoder."""

import hashlib
import re
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vecshoal.functions.blocks import list_column


# Texts given to an encoder at a time.
TEXTS = 256
TOKEN = re.compile(r"[^ \t\n\r\f\v]+")


class HashingEncoder:
    """Deterministic stand-in for a text model: signed token counts, hashed, unit length."""

    def __init__(self, width: int = 64):
        self.width = width
        self.slots: dict[str, tuple[int, int]] = {}

    def slot(self, token: str) -> tuple[int, int]:
        found = self.slots.get(token)
        if found is None:
            number = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
            found = ((number >> 1) % self.width, 1 - 2 * (number & 1))
            if len(self.slots) < 200_000:
                self.slots[token] = found
        return found

    def encode(self, texts: list[str]) -> np.ndarray:
        tokens = [TOKEN.findall(text.lower()) for text in texts]
        places = {token: self.slot(token) for token in set().union(*tokens)}
        found = np.array([places[token] for row in tokens for token in row], dtype=np.int64).reshape(-1, 2)
        row = np.repeat(np.arange(len(texts)), [len(row) for row in tokens])
        cells = np.bincount(row * self.width + found[:, 0], weights=found[:, 1], minlength=len(texts) * self.width)
        out = cells.reshape(len(texts), self.width)
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(lengths == 0, 1.0, lengths)


def encode_text(text: Column, load: Callable[[], object]) -> Column:
    """Encode a text column. ``load`` builds the encoder once per task, then batches flow through.

    Any object with ``encode(list[str]) -> matrix`` will do. NULL text stays NULL.
    """

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load()
        for batch in batches:
            present = batch.is_valid().to_numpy(zero_copy_only=False)
            texts = batch.drop_null().to_pylist()
            if not texts:
                yield pa.nulls(len(batch), pa.list_(pa.float64()))
                continue
            # A few texts at a time, as their tokens take many times their room.
            found = [np.asarray(encoder.encode(texts[at : at + TEXTS]), dtype=np.float64) for at in range(0, len(texts), TEXTS)]
            yield list_column(np.concatenate(found), present)

    return run(text)
