"""Sums of statistics over a distributed table.

Every task folds its batches into a state whose size depends on the model, not on the data; states are
added up in a tree. Fits that pass over a table many times keep it on the executors as blocks of
numbers, so that a pass costs no reading, planning or conversion.
"""

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.functions.blocks import count_widths, fitting, list_column, matrix

# States of all tasks up to this size are added up by the driver; larger ones by tasks, so many at a time.
DIRECT_BYTES = 1 << 20
FAN = 64
# A table for hundreds of passes is dealt evenly to tasks of so many bytes at most, up to so many tasks a core.
EVEN_BYTES = 64 << 20
EVEN_ROUNDS = 4
# Fits whose states are larger than this in all are taken in several passes.
STATE_BYTES = 64 << 20
_ROWS = "slot int, stats array<double>"


def task_limit(df: DataFrame) -> int:
    return max(4096, 4 * df.sparkSession.sparkContext.defaultParallelism)


def fewer_tasks(df: DataFrame) -> DataFrame:
    """Let one task take several splits when there are far more splits than cores.

    Tasks stream their input, so size costs no memory, and each emits its state only once.
    """
    return df.coalesce(task_limit(df))


def spread(df: DataFrame, key: str | None = None, rows_per_task: int = 256) -> DataFrame:
    """Share a table of fewer splits than cores among more of them, before heavy work on its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores:
        return df
    wanted = min(cores, -(-df.count() // rows_per_task))
    return df.repartition(wanted, *([key] if key else [])) if wanted > splits else df


def dealt_evenly(df: DataFrame, vector: str = "v") -> DataFrame:
    """A table for hundreds of passes with as many rows in every split, and a split for every core.

    Splits of files are as uneven as these: one may hold all rows, and a few more splits than cores leave most cores waiting in every pass. With one
    split a core, the executors hold equal shares of what is kept. Only a table that is large for its cores gets more, and a very large one stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df
    elements = df.agg(F.sum(F.array_size(vector))).first()[0] or 0
    rounds = max(1, -(-8 * elements // (EVEN_BYTES * cores)))
    return df.repartition(rounds * cores) if rounds <= EVEN_ROUNDS else df


def common_width(rows: DataFrame, vector: str) -> tuple[int, int]:
    """The most common number of elements among all vectors (0 without any), and the count of all rows."""
    counted = rows.groupBy(F.coalesce(F.array_size(vector), F.lit(-1)).alias("width")).count().collect()
    widths = {row.width: row["count"] for row in counted}
    return most_common(widths), sum(widths.values())


def most_common(widths: Mapping[int, int]) -> int:
    """The width of the largest count, the least of equally common ones; 0 without any."""
    return max((width for width in widths if width > 0), key=lambda width: (widths[width], -width), default=0)


class Blocks:
    """A table of groups and vectors, kept on the executors as blocks ``(groups, matrix)``.

    ``take`` makes blocks from what a partition of ``kept`` holds. What a fold captures goes out with its tasks; Spark broadcasts it by itself if it is large.
    """

    def __init__(self, kept: RDD, width: int, take: Callable = iter):
        self.kept, self.width, self.take, self.tasks = kept, width, take, kept.getNumPartitions()
        self.rdd = kept if take is iter else kept.mapPartitions(take)

    def reduce(self, fold: Callable, merge: Callable, size: int = 0):
        """``fold(blocks)`` of every task, put together by ``merge``; ``size`` is about that of one state in bytes."""
        states = self.rdd.mapPartitions(lambda blocks: [fold(blocks)])
        if self.tasks * size <= DIRECT_BYTES:
            return states.treeReduce(merge, 1)
        with gathered(states, lambda found: [reduce(merge, found)]) as whole:
            return whole.collect()[0]

    def total(self, fold: Callable, slots: int, width: int) -> np.ndarray:
        """The sum of the ``slots x width`` states that ``fold(blocks, state)`` fills."""

        def one(blocks):
            state = np.zeros((slots, width))
            fold(blocks, state)
            return state

        return self.reduce(one, np.add, slots * width * 8)

    def with_model(self, model: RDD, work: Callable) -> RDD:
        """What ``work(model, blocks)`` gives for every task that has blocks; tasks get the only element of ``model`` from the executors, not from the driver."""
        take = self.take

        def run(pairs):
            first = next(pairs, None)
            if first is not None:
                yield from work(first[0], take(block for _, block in chain([first], pairs)))

        return model.cartesian(self.kept).mapPartitions(run)


@contextmanager
def gathered(parts: RDD, merge: Callable, beside: list[RDD] = ()) -> Iterator[RDD]:
    """What ``merge(elements)`` makes of all elements of ``parts`` and of the small RDDs ``beside``, in whatever order, in one partition.

    Where there are many parts, ``merge`` first makes fewer of them. What tasks have made stays on the executors, and at most ``FAN`` parts are fetched by
    the next task, so that nothing but the end goes to whoever asks for it.
    """
    held = []
    try:
        while parts.getNumPartitions():
            held.append(parts.persist(StorageLevel.MEMORY_AND_DISK))
            parts.count()
            many = parts.getNumPartitions()
            if many <= FAN:
                break
            parts = parts.coalesce(-(-many // FAN)).mapPartitions(merge)
        yield parts.ctx.union([*beside, parts]).coalesce(1).mapPartitions(merge)
    finally:
        for rdd in held:
            rdd.unpersist()


@contextmanager
def working_copy(rows: DataFrame, width: int | None = None) -> Iterator[Blocks]:
    """``rows`` of ``(g, v)`` as blocks for many passes; vectors that have not ``width`` finite elements are left out.

    Without ``width`` it is the most common one of all: vectors are put by by width, and the copy is counted. A lost executor
    costs a re-read of the splits it held.
    """

    def pack(batches):
        for batch in batches:
            widths = Counter({width: 0})
            if width is None:
                widths = Counter()
                count_widths(batch.column(1), widths)
            for wide, count in widths.items():
                if wide < 1:
                    continue
                ok, x = fitting(batch.column(1), wide)
                groups = batch.column(0).to_numpy(zero_copy_only=False)[ok].astype(np.int32)
                columns = [pa.array([wide]), pa.array([count]), pa.array([groups.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["wide", "count_", "g", "x"])

    def unpack(row):
        return row.wide, row.count_, np.frombuffer(row.g, dtype=np.int32), np.frombuffer(row.x).reshape(-1, row.wide)

    def counts(blocks):
        found = Counter()
        for wide, count, _, _ in blocks:
            found[wide] += count
        return found

    packed = fewer_tasks(spread(rows, rows_per_task=1000)).mapInArrow(pack, "wide long, count_ long, g binary, x binary")
    kept = packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if width is None:
            width = most_common(Blocks(kept, 0).reduce(counts, add)) if kept.getNumPartitions() else 0
        chosen = width
        yield Blocks(kept, width, lambda held: (block[2:] for block in held if block[0] == chosen and len(block[2])))
    finally:
        kept.unpersist()


def _slot_rows(used: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), list_column(state)], names=["slot", "stats"])


def sum_over_tasks(
    df: DataFrame, fold: Callable[[Iterable[pa.RecordBatch], np.ndarray, Counter], None], slots: int, width: int
) -> tuple[np.ndarray, Counter]:
    """Run ``fold(batches, state, counts)`` once over a table; the sums of the ``slots x width`` states and of the counts of whole numbers from -1."""

    def partial(batches):
        state, counts = np.zeros((slots, width)), Counter()
        fold(batches, state, counts)
        used = np.flatnonzero(state.any(axis=1))
        yield _slot_rows(used, state[used])
        # Counts travel as rows of slots below 0, one at a time, as there may be many.
        for number, count in counts.items():
            yield _slot_rows(np.array([-2 - number]), np.array([[float(count), *[0.0] * (width - 1)]]))

    def add_up(batches):
        # A task holds the sums of its own slots only.
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, stats in zip(batch.column(0).to_pylist(), matrix(batch.column(1), width)):
                sums[slot] = sums[slot] + stats if slot in sums else stats
        if sums:
            yield _slot_rows(np.array(list(sums)), np.array(list(sums.values())))

    partials = fewer_tasks(df).mapInArrow(partial, _ROWS).repartition("slot").mapInArrow(add_up, _ROWS)
    total, counts = np.zeros((slots, width)), Counter()
    for batch in partials.toArrow().to_batches():
        places, stats = batch.column(0).to_numpy(), matrix(batch.column(1), width)
        np.add.at(total, places[places >= 0], stats[places >= 0])
        counts.update({int(-2 - place): int(row[0]) for place, row in zip(places, stats) if place < 0})
    return total, counts


def batches_of(fits: list, size: Callable[[object], int], bound: int) -> list[list]:
    """``fits`` in consecutive batches whose sizes add up to ``bound`` at most, or of one fit."""
    out: list[list] = []
    held = 0
    for fit in fits:
        if not out or held + size(fit) > bound:
            out.append([])
            held = 0
        out[-1].append(fit)
        held += size(fit)
    return out
