"""The k most similar items of each query's cluster.

Items stay where they are: each task scores the items of its own splits against the queries of
their clusters, a block at a time, and keeps k rows per query. Only these go through the
shuffle. A cluster that holds a third of all items is therefore spread over a third of the
tasks, and no row is made for a pair that cannot be in the answer.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.functions import vectors
from vecshoal.functions.blocks import fitting, matrix
from vecshoal.operators.partials import common_width, fewer_tasks, task_limit
from vecshoal.session import materialise

# Queries sent to all tasks, and answers a task may hold; a larger query table is dealt out with the items, in blocks of
# so many rows of either.
QUERY_BYTES = 64 << 20
TASK_ANSWERS = 100_000
BLOCK_ITEMS = 50_000
BLOCK_QUERIES = 10_000
# A cluster is cut into smaller blocks than these only while there are few: a task holds so many items at most and so many queries at a time,
# and scores so many pairs.
FEW_PARTS = 2
PART_ITEMS = 50_000
PART_QUERIES = 1_000
PART_PAIRS = 1 << 32
# Similarities equal to this many digits are ties, decided by id: block products differ in the last bits.
DIGITS = 12
_CELLS = 1 << 22
ITEM_COLUMNS = ("img_name", "url")


def top_k_single(
    items: DataFrame, query, k: int = 20, cluster_id: int | None = None, vector: str = "encd", keep=ITEM_COLUMNS
) -> DataFrame:
    """The k items most similar to one query vector, all in native expressions.

    With ``cluster_id`` only that cluster is read.
    """
    if cluster_id is not None:
        items = items.where(F.col("cluster_id") == cluster_id)
    query = [float(v) for v in query]
    scored = items.where(F.array_size(vector) == len(query)).select(
        "id", *keep, F.round(vectors.cosine(F.col(vector), vectors.literal(query)), DIGITS).alias("similarity")
    )
    best = scored.orderBy(F.desc("similarity"), "id").limit(k)
    place = F.row_number().over(Window.orderBy(F.desc("similarity"), "id"))
    return best.select(place.alias("rank"), "id", *keep, "similarity")


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths == 0, 1.0, lengths)


def _cut(found: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query among candidates, best first."""
    order = pc.sort_indices(
        found, sort_keys=[("query", "ascending"), ("similarity", "descending"), ("id", "ascending")]
    )
    found = found.take(order)
    query = found.column("query").to_numpy()
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    return found.filter(pa.array(place < k))


def _cut_ties(q: np.ndarray, item: np.ndarray, similarity: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best pairs per query of one block whose items are in id order."""
    order = np.lexsort((item, -similarity, q))
    q, item, similarity = q[order], item[order], similarity[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    kept = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)])) < k
    return q[kept], item[kept], similarity[kept]


class _Best:
    """Candidates of one task: at least the k best rows per query seen so far."""

    def __init__(self, queries: int, k: int, schema: pa.Schema):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.kept = schema.empty_table()
        self.fresh: list[pa.Table] = []
        self.waiting = 0
        self.limit = max(50_000, 2 * k * queries)

    def add(self, query: np.ndarray, similarity: np.ndarray, rows: pa.Table) -> None:
        columns = [pa.array(query, type=pa.int32()), pa.array(similarity), *rows.columns]
        self.fresh.append(pa.table(columns, schema=self.kept.schema))
        self.waiting += len(query)
        if self.waiting > self.limit:
            self.prune()

    def prune(self) -> None:
        if not self.waiting:
            return
        self.kept = _cut(pa.concat_tables([self.kept, *self.fresh]).combine_chunks(), self.k)
        self.fresh, self.waiting = [], 0
        query = self.kept.column("query").to_numpy()
        counts = np.bincount(query, minlength=len(self.floor))
        full = counts[query] >= self.k
        # Rows come best first, so the last write per query is its k-th similarity.
        self.floor[query[full]] = self.kept.column("similarity").to_numpy()[full]


def _prepared(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Clusters, unit vectors and payload of items ``(cluster_id, vector, id, payload...)``, in id order, so that among equal similarities
    the lowest ids are met first."""
    ok, points = fitting(batch.column(1), width)
    if not ok.all():
        batch = batch.filter(pa.array(ok))
    order = pc.sort_indices(batch.column(2)).to_numpy()
    payload = pa.table(batch.columns[2:], names=batch.schema.names[2:])
    return batch.column(0).to_numpy()[order], _unit(points)[order], payload.take(pa.array(order))


class _Scan:
    """Answers of one task: items are scored against the queries of their clusters, batch by batch."""

    def __init__(self, by_cluster: dict, count: int, k: int):
        self.by_cluster, self.count, self.k = by_cluster, count, k
        self.best: _Best | None = None

    def add(self, clusters: np.ndarray, points: np.ndarray, payload: pa.Table) -> None:
        """Take in :func:`_prepared` items."""
        if self.best is None:
            fields = [pa.field("query", pa.int32()), pa.field("similarity", pa.float64()), *payload.schema]
            self.best = _Best(self.count, self.k, pa.schema(fields))
        best, k = self.best, self.k
        for c in np.unique(clusters):
            at, probes = self.by_cluster.get(int(c), ((), ()))
            mine = np.flatnonzero(clusters == c)
            block = points[mine]
            step = max(1, _CELLS // len(mine))
            for lo in range(0, len(at), step):
                sims = probes[lo : lo + step] @ block.T
                floor = best.floor[at[lo : lo + step]]
                if len(mine) > k and np.isneginf(floor).any():
                    floor = np.maximum(floor, np.partition(sims, len(mine) - k, axis=1)[:, len(mine) - k])
                # Only what may still count is rounded, with room for what rounding may lift.
                q, item = np.nonzero(sims >= (floor - 2 * 10.0**-DIGITS)[:, None])
                found = np.round(sims[q, item], DIGITS)
                if len(q) > 2 * k * len(sims):
                    q, item, found = _cut_ties(q, item, found, k)
                best.add(at[lo + q], found, payload.take(pa.array(mine[item])))

    def answers(self, query_ids: pa.Array) -> pa.Table | None:
        if self.best is None:
            return None
        self.best.prune()
        if not self.best.kept.num_rows:
            return None
        ids = query_ids.take(self.best.kept.column("query"))
        return self.best.kept.drop_columns(["query"]).add_column(0, "query_id", ids).combine_chunks()


def _by_cluster(queries: pa.Table, width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of the queries of each cluster."""
    cluster = queries.column("cluster_id").to_numpy()
    units = _unit(matrix(queries.column("vector").combine_chunks(), width)) if queries.num_rows else np.zeros((0, width))
    return {int(c): (at, units[at]) for c in np.unique(cluster) for at in [np.flatnonzero(cluster == c)]}


def _score_in_place(rows: DataFrame, queries: pa.Table, schema: T.StructType, k: int, width: int) -> DataFrame:
    """Candidates of the queries, sent to all tasks; items are scored where they are read."""
    groups = _by_cluster(queries, width)
    shared = rows.sparkSession.sparkContext.broadcast((groups, queries.column("query_id")))
    count = queries.num_rows

    def task(batches):
        by_cluster, query_ids = shared.value
        scan = _Scan(by_cluster, count, k)
        for batch in batches:
            scan.add(*_prepared(batch, width))
        found = scan.answers(query_ids)
        if found is not None:
            yield from found.to_batches(max_chunksize=10_000)

    return fewer_tasks(rows.where(F.col("cluster_id").isin(list(groups)))).mapInArrow(task, schema)


def parts_of(rows: DataFrame, queries: DataFrame, block_items: int = BLOCK_ITEMS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``cluster_id, items, item_parts, query_parts, before``: into how many parts the items and the queries of each cluster are cut, and how many pairs
    of parts the clusters before it have.

    Each item is copied for every part of the queries and the other way round, so blocks smaller than a task can take are honoured up to ``FEW_PARTS``.
    """
    parts = queries.groupBy("cluster_id").agg(F.count("*").alias("asked")).join(rows.groupBy("cluster_id").agg(F.count("*").alias("items")), "cluster_id")

    def cut(rows: Column, block: int, needed: Column) -> Column:
        return F.least(F.ceil(rows / block), F.greatest(F.lit(FEW_PARTS), F.ceil(needed))).cast("int")

    parts = parts.withColumn("item_parts", cut(F.col("items"), block_items, F.col("items") / PART_ITEMS))
    pairs = F.col("items") / F.col("item_parts") * F.col("asked")
    parts = parts.withColumn("query_parts", cut(F.col("asked"), block_queries, pairs / PART_PAIRS)).drop("asked")
    # One row a cluster.
    so_far = Window.orderBy("cluster_id").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum(F.col("item_parts") * F.col("query_parts")).over(so_far), F.lit(0)))


def meet(rows: DataFrame, queries: DataFrame, parts: DataFrame, hold, work, schema: T.StructType | str, block: int = PART_QUERIES) -> DataFrame:
    """``work(hold(items), some)`` for every part of a cluster's items and some of its queries at a time.

    ``rows`` begin with ``cluster_id`` and have an ``id``; ``queries`` are ``(query_id, cluster_id, vector)``. In a task the items of a part come first and are
    held, and queries stream past them. Pairs of parts are dealt to the tasks in turn, so that no task gets several while another one has none.
    """
    fields = [(f"c{n}", field.dataType) for n, field in enumerate(rows.schema)]
    key = ("cluster_id", "_i", "_q", "_queries")
    groups = parts.agg(F.sum(F.col("item_parts") * F.col("query_parts"))).first()[0] or 1
    tasks = min(groups, task_limit(rows))
    turn = F.pmod(F.col("before") + F.col("_i") * F.col("query_parts") + F.col("_q"), F.lit(tasks)).cast("int").alias("_turn")

    def place(column: str, count: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    asked = [queries.schema[name] for name in ("query_id", "vector")]
    items = rows.join(parts, "cluster_id").withColumn("_i", place("id", "item_parts")).withColumn("_q", every("query_parts"))
    items = items.select(turn, *key[:3], F.lit(0).alias("_queries"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in asked], *[F.col(f.name).alias(name) for f, (name, _) in zip(rows.schema, fields)])
    probes = queries.join(parts, "cluster_id").withColumn("_q", place("query_id", "query_parts")).withColumn("_i", every("item_parts"))
    probes = probes.select(turn, *key[:3], F.lit(1).alias("_queries"), *[f.name for f in asked], *[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    names = rows.columns

    def task(batches):
        group, waiting, held = None, [], None
        for batch in batches:
            marks = np.array([batch.column(n).to_numpy() for n in range(4)])
            starts = np.flatnonzero(np.r_[batch.num_rows > 0, (marks[:, 1:] != marks[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                if tuple(marks[:3, lo]) != group:
                    group, waiting, held = tuple(marks[:3, lo]), [], None
                some = batch.slice(lo, hi - lo)
                if not marks[3, lo]:
                    waiting.append(pa.RecordBatch.from_arrays(some.columns[6:], names=names))
                    continue
                if waiting:
                    held, waiting = hold(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]), []
                if held is not None:
                    for at in range(0, some.num_rows, block):
                        few = some.slice(at, block)
                        yield from work(held, pa.table([few.column(4), few.column(0), few.column(5)], names=["query_id", "cluster_id", "vector"]))

    dealt = items.unionByName(probes).repartitionById(tasks, F.col("_turn")).drop("_turn")
    return dealt.sortWithinPartitions(*key).mapInArrow(task, schema)


def _score_dealt(
    rows: DataFrame, queries: DataFrame, schema: T.StructType, k: int, width: int, block_items: int, block_queries: int
) -> DataFrame:
    """The same for queries too many to send about: parts of a cluster's items meet parts of its queries.

    A task holds one part of the items and a few queries, however large a cluster is.
    """
    names = schema.names

    def hold(batch: pa.RecordBatch) -> tuple:
        return _prepared(batch, width)

    def work(held: tuple, asked: pa.Table):
        scan = _Scan(_by_cluster(asked, width), asked.num_rows, k)
        scan.add(*held)
        found = scan.answers(asked.column("query_id").combine_chunks())
        if found is not None:
            yield from found.select(names).to_batches(max_chunksize=10_000)

    return meet(rows, queries, parts_of(rows, queries, block_items, block_queries), hold, work, schema)


def query_defect(width: int, vector: str = "encd") -> Column:
    """Why a vector query has no answer, or NULL when it has one; repeated ids are told by :func:`split_vector_queries`."""
    v = F.col(vector)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.when(F.col("query_id").isNull(), "missing id")
        .when(v.isNull(), "missing query")
        .when(F.array_size(v) != width, "wrong width")
        .when(broken, "not a number")
    )


def split_vector_queries(queries: DataFrame, width: int, vector: str = "encd") -> tuple[DataFrame, DataFrame]:
    """Queries that can be answered, one row each, and the others with a ``reason``.

    An id that comes with one vector several times is one query; one that comes with different vectors is refused, as
    its answers could not be told apart.
    """
    marked = queries.withColumn("reason", query_defect(width, vector))
    sound = marked.where("reason IS NULL").drop("reason")
    content = F.xxhash64(F.col(vector), *([F.col("cluster_id")] if "cluster_id" in queries.columns else []))
    ids = sound.groupBy("query_id").agg(F.min(content).alias("a"), F.max(content).alias("b"))
    twice = ids.where("a <> b").select("query_id")
    good = sound.join(twice, "query_id", "left_anti").dropDuplicates(["query_id"])
    repeated = sound.join(twice, "query_id", "left_semi").withColumn("reason", F.lit("repeated id"))
    refused = marked.where("reason IS NOT NULL").unionByName(repeated)
    return good.select(*queries.columns), refused.select(*queries.columns, "reason")


def top_k(
    items: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vector: str = "encd",
    keep=ITEM_COLUMNS,
    width: int | None = None,
    query_bytes: int = QUERY_BYTES,
    block_items: int = BLOCK_ITEMS,
    block_queries: int = BLOCK_QUERIES,
    checked: bool = False,
) -> DataFrame:
    """The k most similar items of its cluster for every query; fewer where the cluster has fewer.

    ``items`` holds ``id``, ``cluster_id`` and ``vector``; ``queries`` holds ``query_id`` (string
    or whole number), ``cluster_id`` and ``vector``. Rank 1 is the most similar.

    Vectors have ``width`` elements (default: the most common number among the items). What :func:`split_vector_queries`
    refuses has no answer (``checked`` queries have been through it), and a query of a cluster without items has none either. Queries up to
    ``query_bytes`` are sent to the tasks; more are dealt out with the items, in one shuffle. ``block_items`` and ``block_queries`` are
    the blocks of a cluster then; see :func:`parts_of`.
    """
    if width is None:
        width = max(1, common_width(items, vector)[0])
    wanted = queries.select("query_id", "cluster_id", F.col(vector).alias("vector"))
    if not checked:
        wanted, _ = split_vector_queries(wanted, width, "vector")
    wanted = wanted.where(F.col("cluster_id").isNotNull())
    rows = items.where(F.array_size(vector) == width).select("cluster_id", vector, "id", *keep)
    extra = [rows.schema[name] for name in ("id", *keep)]
    schema = T.StructType([wanted.schema["query_id"], T.StructField("similarity", T.DoubleType()), *extra])
    most = max(1, min(query_bytes // (8 * width + 64), TASK_ANSWERS // k))
    head = wanted.limit(most + 1).toArrow()
    if head.num_rows <= most:
        found = _score_in_place(rows, head, schema, k, width)
    else:
        # Counted and dealt: worked out once.
        wanted, _ = materialise(wanted, "queries")
        found = _score_dealt(rows, wanted, schema, k, width, block_items, block_queries)
    place = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", *keep, "similarity")


def result_lists(results: DataFrame) -> DataFrame:
    """One row per query: names and similarities in rank order, and the addresses as lines of text."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "img_name", "similarity", "url")))
    grouped = results.groupBy("query_id").agg(rows.alias("r"))
    return grouped.select(
        "query_id",
        F.col("r.img_name").alias("names"),
        F.col("r.similarity").alias("similarities"),
        F.array_join("r.url", "\n").alias("urls"),
    )


def split_queries(queries: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Queries that can be answered, and the others with a ``reason``."""
    reason = (
        F.when(F.col(text).isNull(), "missing query")
        .when(F.col(text) == "", "empty query")
        .when(F.col(text).rlike(r"^\s+$"), "blank query")
    )
    marked = queries.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
