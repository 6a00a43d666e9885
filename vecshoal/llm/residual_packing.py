"""Packing whole documents into sequences: best fit by partition, then a tree of rounds over what stays underfull.

1. Each task tokenises its rows as they stream by. A document longer than a window is cut into full windows, which need no
   packing, and a shorter first piece; nothing else is cut. Pieces are packed best-fit, longest first, a buffer at a time: each goes to the bin
   with the least room that holds it. Nearly full bins (at most ``slack`` ids of room) are done, the others are items of the next buffer's round.
2. Bins still underfull at the end of a task go up a tree of ``fan`` tasks a node, as whole items. Each node packs the bins of its
   children best-fit, lets nearly full ones go and hands the rest to the next level, up to one root.
3. What moved is attached to the stored pieces of underfull bins; all other pieces are already in place.

Only bins and their sizes travel in the tree, no ids. After a best-fit round two bins never fit together, so of a node's bins at most one is
half empty or more; the nodes of a level can thus use no more fuller bins than there are nodes. A node hands on its emptiest bins up to that
number (``least_carried`` at least); those left behind are done as they are, so what a task holds has a bound and no piece is lost.

A task that runs again makes the same bins, as they depend on its own rows only. Cases: a NULL text is an empty one and still yields its end
id; a NULL id stays NULL; repeated rows are documents of their own; an empty table gives no pieces; other columns of the input, whatever their
names, are not carried along.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vecshoal.llm.common import kept_at, whole
from vecshoal.session import remove_path

#: The byte-level tokenizer's own pattern for the parts of a text.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokens:
    """Token ids of texts, as little-endian 32-bit bytes, by a byte-level byte-pair tokenizer file.

    Merges run on the same vocabulary in ``tiktoken``; a text with a special token or with very long runs of white
    space, and any other kind of tokenizer, goes to ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path) as file:
            kind = json.load(file)
        self.path, self.encoder = path, None
        self.special = [token["content"] for token in kind["added_tokens"]]
        self.merges = byte_merges(kind)

    def plain(self, text: str) -> bytes:
        if self.encoder is None:
            from tokenizers import Tokenizer

            self.encoder = Tokenizer.from_file(self.path)
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.merges is None or any(token in text for token in self.special):
            return self.plain(text)
        try:
            return self.merges.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # its patterns give up on very long runs of white space
            return self.plain(text)


def byte_merges(kind: dict):
    """The encoding of a plain byte-level tokenizer file whose ids are in merge order, else None."""
    model, before = kind["model"], kind["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
    if not plain or kind["normalizer"] or model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    joined = ["".join(merge.split(" ") if isinstance(merge, str) else merge) for merge in model["merges"]]
    if any(model["vocab"].get(token) != 256 + number for number, token in enumerate(joined)):
        return None
    import tiktoken

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(printable)]
    byte_of = {chr(byte): byte for byte in printable} | {chr(256 + n): byte for n, byte in enumerate(hidden)}
    ranks = {bytes(map(byte_of.get, token)): number for token, number in model["vocab"].items() if all(sign in byte_of for sign in token)}
    return tiktoken.Encoding("bytes", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})


def best_fit(sizes: list[int], window: int) -> list[list[int]]:
    """Item numbers by bin; items are placed largest first, each where least room is left.

    The rooms in use are the bits of one number, so the tightest room of at least ``size`` is the lowest bit left of it.
    """
    bins: list[list[int]] = []
    at: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fitting = rooms >> sizes[item]
        if fitting:
            room = sizes[item] + (fitting & -fitting).bit_length() - 1
            number = at[room].pop()
            if not at[room]:
                rooms ^= 1 << room
            bins[number].append(item)
        else:
            room, number = window, len(bins)
            bins.append([item])
        left = room - sizes[item]
        if left:
            at[left].append(number)
            rooms |= 1 << left
    return bins


def packed_by_task(docs: DataFrame, tokenizer_path: str, window: int, end_id: int, slack: int, buffer_ids: int) -> DataFrame:
    """Pieces of all documents in the bins of their task; ``fill`` is the size of the bin, ``open`` marks underfull ones."""
    end = np.array([end_id], dtype="<u4").tobytes()
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
            T.StructField("ids", T.BinaryType()), T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
            T.StructField("fill", T.IntegerType()), T.StructField("open", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [id_type, pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        names = ["doc_id", "piece", "start", "ids", "bin", "offset", "fill", "open"]
        encoder = ByteTokens(tokenizer_path)
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[int, list[tuple]]] = []  # size and pieces of bins not yet given out
        held_ids = 0

        def rows_of(bins: list[tuple[int, list[tuple]]], is_open: bool) -> Iterator[tuple]:
            nonlocal number
            for size, pieces in bins:
                offset = 0
                for doc, piece, start, ids in pieces:
                    yield doc, piece, start, ids, number, offset, size, is_open
                    offset += len(ids) // 4
                number += 1

        def batches_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(rows), 4096):
                columns = [pa.array(column, type=kind) for column, kind in zip(zip(*rows[at : at + 4096]), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        def round_() -> list[tuple]:
            """Packs what is held; rows of the bins that are done."""
            nonlocal held, held_ids
            bins = [[held[i] for i in members] for members in best_fit([size for size, _ in held], window)]
            bins = [(sum(size for size, _ in members), [piece for _, pieces in members for piece in pieces]) for members in bins]
            done = [one for one in bins if window - one[0] <= slack]
            held = sorted((one for one in bins if window - one[0] > slack), key=lambda one: one[0])
            held_ids = sum(size for size, _ in held)
            rows = list(rows_of(done, False))
            # Bins that found no partner would fill the buffer for good: the fullest go up the tree as they are.
            early = []
            while held_ids > buffer_ids // 2:
                early.append(held.pop())
                held_ids -= early[-1][0]
            return rows + list(rows_of(early, True))

        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            full = []
            for at, doc in enumerate(ids_of):
                ids = encoder.encode(texts[at].as_py()) + end
                first, piece = len(ids) // 4 % window, 0
                if first:
                    held.append((first, [(doc, 0, 0, ids[: 4 * first])]))
                    held_ids += first
                    piece = 1
                for start in range(first, len(ids) // 4, window):
                    full.append((window, [(doc, piece, start, ids[4 * start : 4 * (start + window)])]))
                    piece += 1
                if len(full) >= 1024:
                    yield from batches_of(list(rows_of(full, False)))
                    full = []
                if held_ids > buffer_ids:
                    yield from batches_of(round_())
            yield from batches_of(list(rows_of(full, False)))
        yield from batches_of(round_())
        yield from batches_of(list(rows_of(held, True)))

    return docs.mapInArrow(run, schema)


MEMBERS = "array<struct<bin: bigint, shift: int>>"


def tree_rounds(bins: DataFrame, window: int, slack: int, fan: int, least_carried: int) -> tuple[DataFrame, list[str]]:
    """``bin, sequence_id, shift`` of the bins that were merged into others, from ``node, bin, size``; and the folders in use."""
    spark = bins.sparkSession
    nodes = (bins.agg(F.max("node")).first()[0] or 0) + 1
    first = Window.partitionBy("node").orderBy("size", "bin")
    level = bins.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max(least_carried, nodes))
    level = level.select("node", "size", F.array(F.struct("bin", F.lit(0).alias("shift"))).cast(MEMBERS).alias("members"))
    moved, paths = None, []
    while True:
        parents = -(-nodes // fan)
        carried = max(least_carried, parents)

        def node(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table["size"].to_pylist(), table["members"].to_pylist()), key=lambda row: (-row[0], row[1][0]["bin"]))
            out = []
            for placed in best_fit([size for size, _ in rows], window):
                size, members = 0, []
                for item in placed:
                    members += [{"bin": m["bin"], "shift": m["shift"] + size} for m in rows[item][1]]
                    size += rows[item][0]
                out.append((size, members))
            out.sort(key=lambda row: (row[0], row[1][0]["bin"]))
            up = [parents > 1 and at < carried and window - size > slack for at, (size, _) in enumerate(out)]
            parent = table["parent"][0].as_py()
            return pa.table(
                {
                    "node": pa.array([parent] * len(out), type=pa.int64()),
                    "size": pa.array([size for size, _ in out], type=pa.int32()),
                    "members": pa.array([m for _, m in out], type=pa.list_(pa.struct([("bin", pa.int64()), ("shift", pa.int32())]))),
                    "up": pa.array(up, type=pa.bool_()),
                }
            )

        grouped = level.withColumn("parent", F.floor(F.col("node") / fan)).groupBy("parent")
        packed, path = kept_at(grouped.applyInArrow(node, f"node long, size int, members {MEMBERS}, up boolean"), "packing-level")
        paths.append(path)
        done = packed.where(~F.col("up") & (F.size("members") > 1)).select("members")
        moved = done if moved is None else moved.unionByName(done)
        if parents == 1:
            break
        level, nodes = packed.where("up").drop("up"), parents
    moved = moved.select(F.col("members")[0]["bin"].alias("sequence_id"), F.explode("members").alias("m"))
    return moved.select(F.col("m.bin").alias("bin"), "sequence_id", F.col("m.shift").alias("shift")), paths


def pack_whole(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 1024,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    slack: int = 2,
    buffer_ids: int = 8_000_000,
    fan: int = 16,
    least_carried: int = 4096,
) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``: the pieces of all documents with their place.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers, ``start`` the number of its document's ids before it. Sequence
    ids are unique, not consecutive.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    pieces, _ = kept_at(packed_by_task(rows, tokenizer_path, window, end_id, slack, buffer_ids), "pieces")
    node = F.shiftright("bin", 33).alias("node")
    underfull = pieces.where(F.col("open") & (F.col("offset") == 0)).select(node, "bin", F.col("fill").alias("size"))
    moved, paths = tree_rounds(underfull, window, slack, fan, least_carried)
    moves, _ = kept_at(moved, "moves")
    for path in paths:
        remove_path(docs.sparkSession, path)
    length = F.floor(F.length("ids") / 4).alias("length")
    done = pieces.where(~F.col("open")).select("doc_id", "piece", "start", length, "ids", F.col("bin").alias("sequence_id"), "offset")
    placed = pieces.where("open").join(moves, "bin", "left")
    sequence = F.coalesce("sequence_id", "bin").alias("sequence_id")
    offset = (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")
    return done.unionByName(placed.select("doc_id", "piece", "start", length, "ids", sequence, offset))
