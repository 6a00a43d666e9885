"""Packing tokenised documents into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows, which need no packing. What
remains of each document is packed, longest first, into the open window with the least room
that still holds it; a segment tree over remaining capacities finds that window. Where pieces are too long to share
windows well, windows still over 1/64 empty are topped up by cutting pieces of the emptiest ones.

Packing needs no shuffle. Each task tokenises its rows as they stream by, holds at most
``buffer_tokens`` tokens, packs them, gives out the windows that are nearly full and carries the
others over to the next buffer. A task that is run again makes the same windows, as they
depend on its own rows only.

Cases: a NULL text is an empty one and still yields its end id; a NULL id stays NULL; repeated rows are documents
of their own; an empty table gives no pieces; other columns of the input, whatever their names, are not carried along.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.llm.common import whole

#: Words whose normal form is their lower case.
PLAIN = re.compile("[!-~\u00a1-\u024f]*")
#: The tokenizer's own pattern for the parts of a text.
PART = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Occurs in no UTF-8 text.
WORD_END = b"\xff"


class WordTokens:
    """Token ids of texts as little-endian 32-bit bytes.

    A byte-pair tokenizer with word ends that drops white space and never joins across it gives a text the ids
    of its words in turn. Words are then encoded once and remembered, up to ``remember`` of them. The merges of plain
    words run on the same vocabulary in ``tiktoken``, with a byte that no text holds as the word end; any
    other word, and any other kind of tokenizer, goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str, remember: int = 500_000):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.remember = remember
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        with open(path) as file:
            kind = json.load(file)
        self.by_word = joins_words_never(kind)
        self.merge = merges(kind["model"]) if self.by_word else None

    def word(self, word: str) -> bytes:
        if "<|" in word or not PLAIN.fullmatch(word):
            return as_bytes(self.encoder.encode(word, add_special_tokens=False).ids)
        lower = word.lower()
        if lower.isalpha():
            return self.part(lower)
        if lower[:-1].isalpha() and lower[-1] in ".,":
            return self.part(lower[:-1]) + self.part(lower[-1])
        return b"".join(map(self.part, PART.findall(lower)))

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = as_bytes(self.merge(part.encode() + WORD_END))
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [as_bytes(found.ids) for found in self.encoder.encode_batch(texts, add_special_tokens=False)]
        split = [blanks(text).split(" ") for text in texts]
        if len(self.known) + len(self.parts) > self.remember:
            self.known, self.parts = {}, {}
        known = self.known
        for word in set().union(*split).difference(known):
            known[word] = self.word(word)
        return [b"".join(map(known.__getitem__, words)) for words in split]


def word_tokens(path: str) -> WordTokens:
    """The encoder of a tokenizer file, with the words it remembers, kept by the Python worker from task to task.

    Task functions and the names beside them come anew with every task, so it is kept among the worker's modules.
    """
    kept = sys.modules.setdefault("_word_tokens", types.ModuleType("_word_tokens")).__dict__
    known = (path, os.stat(path).st_mtime_ns)
    if known not in kept:
        kept[known] = WordTokens(path)
    return kept[known]


def blanks(text: str) -> str:
    return text.replace("\n", " ").replace("\r", " ").replace("\t", " ")


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def joins_words_never(kind: dict) -> bool:
    """Whether the tokenizer file is a lower-casing byte-pair model with word ends that splits at white space."""
    normal = [step["type"] for step in (kind["normalizer"] or {}).get("normalizers", [])]
    model = kind["model"]
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and kind["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": PART.pattern}
        and model.get("end_of_word_suffix") == "</w>"
        and not model.get("continuing_subword_prefix")
    )


def merges(model: dict):
    """The model's merges as a function from the bytes of a word and its end to ids.

    Ids of such a vocabulary are in merge order, and serve as ranks.
    """
    import tiktoken

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(printable)]
    byte_of = {chr(byte): byte for byte in printable} | {chr(256 + n): byte for n, byte in enumerate(hidden)}
    ranks: dict[bytes, int] = {}
    for token, number in model["vocab"].items():
        body = token.removesuffix("</w>")
        if all(sign in byte_of for sign in body) and not token.startswith("<|"):
            ranks.setdefault(bytes(map(byte_of.get, body)) + WORD_END * (body != token), number)
    return tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree for the tightest fit."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = bytearray(2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, capacity: int, number: int) -> None:
        self.at[capacity].append(number)
        node = capacity + self.size
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The least capacity of at least ``need``, and one window that has it."""
        tree, node = self.tree, need + self.size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        number = self.at[capacity].pop()
        if not self.at[capacity]:
            tree[node] = 0
            while node > 1 and not tree[node ^ 1]:
                node >>= 1
                tree[node] = 0
        return capacity, number


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Piece numbers by window; pieces are placed longest first, each where least room is left."""
    open_windows = OpenWindows(window)
    windows: list[list[int]] = []
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        found = open_windows.take(lengths[piece])
        if found is None:
            found = window, len(windows)
            windows.append([])
        capacity, number = found
        windows[number].append(piece)
        if capacity > lengths[piece]:
            open_windows.put(capacity - lengths[piece], number)
    return windows


def top_up(windows: list[list[tuple]], window: int, slack: int) -> list[list[tuple]]:
    """Windows with more room than ``slack`` filled by cutting pieces of the emptiest; all but one are then nearly full.

    A piece is ``(document, start, ids as 4-byte numbers, tokens of the document)``.
    """
    room = [window - sum(len(piece[2]) for piece in pieces) // 4 for pieces in windows]
    by_room = sorted(range(len(windows)), key=room.__getitem__)
    windows, room = [list(windows[w]) for w in by_room], [room[w] for w in by_room]
    fill, empty = 0, len(windows) - 1
    while fill < empty:
        if room[fill] <= slack:
            fill += 1
        elif not windows[empty]:
            empty -= 1
        else:
            doc, start, ids, total = windows[empty].pop()
            cut = min(room[fill], len(ids) // 4)
            windows[fill].append((doc, start, ids[: 4 * cut], total))
            room[fill] -= cut
            room[empty] += cut
            if cut < len(ids) // 4:
                windows[empty].append((doc, start + cut, ids[4 * cut :], total))
    return [pieces for pieces in windows if pieces]


def pieces_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    buffer_tokens: int = 4_000_000,
) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers, ``start`` the number of its
    document's ids before it, ``offset`` its place in the sequence. Sequence ids are unique, not consecutive.
    """
    schema = pieces_schema(docs.schema[doc_id].dataType)
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows_to_batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, type=field.type) for column, field in zip(zip(*rows), arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema(
            [("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
             ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
        )
        encoder, slack = word_tokens(tokenizer_path), window // 64
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        held_tokens = 0

        def close(last: bool) -> tuple[list[tuple], list[tuple]]:
            """Rows of finished windows, and pieces carried over."""
            nonlocal sequence
            packed = best_fit_decreasing([len(piece[2]) // 4 for piece in held], window)
            windows = top_up([[held[p] for p in members] for members in packed], window, slack)
            rows, carried = [], []
            for pieces in windows:
                filled = sum(len(piece[2]) for piece in pieces) // 4
                if not last and window - filled > slack:
                    carried.extend(pieces)
                    continue
                offset = 0
                for doc, start, ids, total in pieces:
                    rows.append((doc, start, len(ids) // 4, ids, total, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            return rows, carried

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = batch.column(1)
            for at in range(0, len(ids_of), 256):
                full = []
                for doc, ids in zip(ids_of[at : at + 256], encoder.encode(texts.slice(at, 256).to_pylist())):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        if len(piece) == 4 * window:
                            full.append((doc, start, window, piece, total, sequence, 0))
                            sequence += 1
                        else:
                            held.append((doc, start, piece, total))
                            held_tokens += len(piece) // 4
                if full:
                    yield rows_to_batch(full, arrow)
                if held_tokens > buffer_tokens:
                    rows, held = close(last=False)
                    held_tokens = sum(len(piece[2]) // 4 for piece in held)
                    yield rows_to_batch(rows, arrow)
        rows, held = close(last=True)
        for at in range(0, len(rows), 4096):
            yield rows_to_batch(rows[at : at + 4096], arrow)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(schema["doc_id"].dataType)
    return docs.select(F.col(doc_id), whole(text)).mapInArrow(run, schema)
