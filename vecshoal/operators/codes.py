"""Exact top-k over short codes: most vectors are ruled out by one byte an element and never read.

A vector of length one is kept as whole numbers from -127 to 127, a scale, and the length of what rounding took away. By the
Cauchy-Schwarz inequality the similarity to a query lies that length at most from the one of the code. An item goes on if its upper bound reaches
the k-th lower bound of its query; only such items are scored by their vectors, so the answers are the same as without codes.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.functions.blocks import fitting, matrix
from vecshoal.operators import search
from vecshoal.operators.joins import local_copy
from vecshoal.operators.partials import fewer_tasks
from vecshoal.session import materialise

CODE_COLUMNS = ("code", "scale", "slack")
LARGEST = 127
# Similarities are rounded to ``search.DIGITS``, which may lift an item to the k-th place.
MARGIN = 4 * 10.0**-search.DIGITS
# Candidates whose ids are listed in the filter of the scan, so that files' Bloom filters skip row groups.
LISTED_IDS = 1_000
# Queries and items whose pairs are counted at a time, so that scores stay in cache.
_TILE = (256, 512)


def encode(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and bounds of the error of the similarity, for the rows of a matrix."""
    unit = search._unit(rows)
    scale = np.abs(unit).max(axis=1, initial=0) / LARGEST
    codes = np.rint(unit / np.where(scale > 0, scale, 1.0)[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1) + MARGIN


def with_codes(items: DataFrame, vector: str, width: int) -> DataFrame:
    """Add ``code, scale, slack``; NULL for a vector that does not fit."""

    @F.arrow_udf("code binary, scale double, slack double")
    def coded(column: pa.Array) -> pa.Array:
        ok, rows = fitting(column, width)
        codes, scale, slack = encode(rows)
        ends = np.concatenate([[0], np.cumsum(ok * width)]).astype(np.int32)
        valid = pa.py_buffer(np.packbits(ok, bitorder="little").tobytes())
        code = pa.Array.from_buffers(pa.binary(), len(ok), [valid, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
        parts = np.zeros((2, len(ok)))
        parts[0, ok], parts[1, ok] = scale, slack
        return pa.StructArray.from_arrays([code, *(pa.array(x, mask=~ok) for x in parts)], names=list(CODE_COLUMNS))

    marked = items.withColumn("_coded", coded(vector))
    return marked.withColumns({name: F.col(f"_coded.{name}") for name in CODE_COLUMNS}).drop("_coded")


class _Bounds:
    """Bounds of one task: the pairs whose upper bound reaches the k-th lower bound of the query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.held: list[tuple] = []
        self.waiting, self.limit = 0, 200_000

    def add(self, query: np.ndarray, lower: np.ndarray, upper: np.ndarray, ids: np.ndarray) -> None:
        self.held.append((query, lower, upper, ids))
        self.waiting += len(query)
        if self.waiting > self.limit:
            self.prune()

    def prune(self) -> None:
        if not self.held:
            return
        query, lower, upper, ids = map(np.concatenate, zip(*self.held))
        order = np.lexsort((-lower, query))
        starts = np.flatnonzero(np.concatenate([[True], query[order][1:] != query[order][:-1]]))
        sizes = np.diff(np.append(starts, len(order)))
        full = starts[sizes >= self.k]
        self.floor[query[order[full]]] = lower[order[full + self.k - 1]]
        keep = upper >= self.floor[query]
        self.held, self.waiting = [(query[keep], lower[keep], upper[keep], ids[keep])], 0
        self.limit = max(200_000, 2 * int(keep.sum()))


def candidates(coded: DataFrame, queries: pa.Table, k: int, width: int) -> DataFrame:
    """``query, id, lower, upper`` of the items that may be among the ``k`` best of a query, told by its row number.

    ``coded`` holds ``id, cluster_id`` and the codes; ``queries`` is sent to all tasks.
    """
    groups = search._by_cluster(queries, width)
    shared = coded.sparkSession.sparkContext.broadcast(groups)
    count, kind = queries.num_rows, coded.schema["id"].dataType.simpleString()
    rows = coded.where(F.col("code").isNotNull() & F.col("cluster_id").isin(list(groups))).select("cluster_id", "id", *CODE_COLUMNS)

    def task(batches):
        by_cluster, bounds = shared.value, _Bounds(count, k)
        for batch in batches:
            clusters = batch.column(0).to_numpy()
            ids = np.array(batch.column(1).to_pylist(), dtype=object)
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int8).reshape(-1, width)
            scale, slack = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for c in np.unique(clusters):
                at, probes = by_cluster.get(int(c), ((), ()))
                mine = np.flatnonzero(clusters == c)
                block = codes[mine].astype(np.float64) * scale[mine, None]
                step = max(1, search._CELLS // len(mine))
                for lo in range(0, len(at), step):
                    about = probes[lo : lo + step] @ block.T
                    floor = bounds.floor[at[lo : lo + step]]
                    if len(mine) > k:
                        lowest = np.partition(about - slack[mine], len(mine) - k, axis=1)[:, len(mine) - k]
                        floor = np.maximum(floor, lowest)
                    q, item = np.nonzero(about + slack[mine] >= floor[:, None])
                    found = about[q, item]
                    bounds.add(at[lo + q], found - slack[mine[item]], found + slack[mine[item]], ids[mine[item]])
        bounds.prune()
        for query, lower, upper, ids in bounds.held:
            columns = [pa.array(query, type=pa.int32()), pa.array(ids.tolist(), type=batch.schema.field("id").type), pa.array(lower), pa.array(upper)]
            yield from pa.table(columns, names=["query", "id", "lower", "upper"]).to_batches(max_chunksize=10_000)

    found = fewer_tasks(rows).mapInArrow(task, f"query int, id {kind}, lower double, upper double")
    return _best_bounds(found, "query", k)


def most_queries(k: int, width: int) -> int:
    """How many queries are sent to all tasks."""
    return max(1, min(search.QUERY_BYTES // (8 * width + 64), search.TASK_ANSWERS // k))


def candidates_dealt(coded: DataFrame, queries: DataFrame, k: int, width: int, vector: str | None = None, within: float | None = None) -> DataFrame:
    """As :func:`candidates` for queries too many to send about: ``query_id, cluster_id, id, lower, upper``, and the ``similarity`` of the item's ``vector``
    if that is named.

    Parts of a cluster's items meet its queries, and pairs stream out of the tasks. Only where a query meets several parts and may leave out items, its
    pairs are compared once more. With ``within`` the pairs are counted instead, by the tasks that make them: rows of ``cluster_id, pairs, held`` to be added up, where
    ``held`` pairs have their similarity between bounds less than ``within`` apart.
    """
    rows = coded.where(F.col("code").isNotNull()).select("cluster_id", "id", *CODE_COLUMNS, *([vector] if vector else []))
    parts, _ = materialise(search.parts_of(rows, queries), "parts")
    numbers = ["lower", "upper", *(["similarity"] if vector else [])]
    schema = T.StructType([queries.schema["query_id"], queries.schema["cluster_id"], rows.schema["id"], *(T.StructField(name, T.DoubleType()) for name in numbers)])
    names = schema.names

    def hold(batch):
        codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int8).reshape(-1, width)
        scale, slack = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        own = search._unit(matrix(batch.column(5), width)) if vector else None
        return codes.astype(np.float64) * scale[:, None], slack, batch.column(1), own

    def unit(asked):
        return search._unit(matrix(asked.column("vector").combine_chunks(), width))

    def lowest(about, slack):
        if about.shape[1] <= k:
            return np.full((len(about), 1), -np.inf)
        return np.partition(about - slack, about.shape[1] - k, axis=1)[:, about.shape[1] - k, None]

    def work(held, asked):
        block, slack, ids, own = held
        asked = asked.combine_chunks()
        probes = unit(asked)
        step = max(1, search._CELLS // 4 // len(block))
        for lo in range(0, len(probes), step):
            some = probes[lo : lo + step]
            about = some @ block.T
            query, item = np.nonzero(about + slack >= lowest(about, slack))
            found = [about[query, item] - slack[item], about[query, item] + slack[item]]
            if vector:
                found.append((some @ own.T)[query, item])
            for at in range(0, len(query), 10_000):
                named, here = asked.select(["query_id", "cluster_id"]).take(pa.array(lo + query[at : at + 10_000])).combine_chunks(), slice(at, at + 10_000)
                columns = [named.column("query_id"), named.column("cluster_id"), ids.take(pa.array(item[here])), *(pa.array(x[here]) for x in found)]
                yield from pa.table(columns, names=names).to_batches()

    def counted(held, asked):
        block, slack, _, own = held
        probes, pairs, sound = unit(asked), 0, 0
        # Without a lowest bound to reach, items are taken a few at a time.
        wide = _TILE[1] if len(block) <= k else len(block)
        step = max(1, _TILE[0] * _TILE[1] // wide)
        for lo in range(0, len(probes), step):
            some = probes[lo : lo + step]
            for at in range(0, len(block), wide):
                here = slice(at, at + wide)
                about, room = some @ block[here].T, slack[here]
                lower, upper = about - room, about + room
                kept = upper >= lowest(about, room)
                similarity = some @ own[here].T
                pairs += int(np.count_nonzero(kept))
                sound += int(np.count_nonzero(kept & (lower <= similarity) & (similarity <= upper) & (upper - lower < within)))
        yield from pa.table([asked.column("cluster_id")[:1], pa.array([pairs]), pa.array([sound])], names=["cluster_id", "pairs", "held"]).to_batches()

    again = not parts.where((F.col("item_parts") > 1) & (F.col("items") > k)).isEmpty()
    if within is not None and not again:
        sums = T.StructType([queries.schema["cluster_id"], T.StructField("pairs", T.LongType()), T.StructField("held", T.LongType())])
        return search.meet(rows, queries, parts, hold, counted, sums)
    found = search.meet(rows, queries, parts, hold, work, schema)
    if again:
        found = _best_bounds(found, "query_id", k)
    if within is None:
        return found
    held = F.col("similarity").between(F.col("lower"), F.col("upper")) & (F.col("upper") - F.col("lower") < within)
    return found.groupBy("cluster_id").agg(F.count("*").alias("pairs"), F.count_if(held).alias("held"))


def _best_bounds(found: DataFrame, query: str, k: int) -> DataFrame:
    """The pairs whose upper bound reaches the ``k``-th lower bound of their query."""
    best_first = Window.partitionBy(query).orderBy(F.desc("lower"))
    everything = best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kth = F.nth_value("lower", k).over(everything)
    return found.withColumn("floor", kth).where(F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))).drop("floor")


def top_k_coded(items: DataFrame, queries: DataFrame, k: int, vector: str, width: int, keep=search.ITEM_COLUMNS, checked: bool = False) -> DataFrame:
    """As :func:`search.top_k`, for items with codes of ``vector``: codes are scanned, then the vectors of the candidates alone.

    A query table too large to send to all tasks concerns most items, and is answered without codes.
    """
    wanted = queries.select("query_id", "cluster_id", F.col(vector).alias("vector"))
    if not checked:
        wanted, _ = search.split_vector_queries(wanted, width, "vector")
    wanted = wanted.where(F.col("cluster_id").isNotNull())
    most = most_queries(k, width)
    head = wanted.limit(most + 1).toArrow()
    named = wanted.withColumnRenamed("vector", vector)
    if head.num_rows > most:
        return search.top_k(items, named, k, vector, keep, width, checked=True)
    ids, _ = materialise(candidates(items, head, k, width).select("id").distinct(), "candidates")
    return search.top_k(some_of(items, ids), named, k, vector, keep, width, checked=True)


def some_of(items: DataFrame, ids: DataFrame) -> DataFrame:
    """The items with these ids: a few by a filter that reaches the scan, more by a semi-join."""
    few = ids.limit(LISTED_IDS + 1).toArrow()
    if few.num_rows <= LISTED_IDS:
        return items.where(F.col("id").isin(few.column(0).to_pylist()))
    small = local_copy(ids)
    return items.join(F.broadcast(small) if small is not None else ids, "id", "left_semi")
