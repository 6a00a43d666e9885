"""Join of near-equal texts: Jaccard similarity of word n-grams, found by chosen paths.

Texts with equal n-gram sets form one node; what follows works on nodes. Each set is embedded as ``coordinates`` MinHash values,
tokens that two sets share with a chance equal to their similarity.

1. Chosen paths. Each of ``runs`` runs, or more, splits all sets on one sampled token. A bucket of at most ``brute`` sets is compared by the
   embedded tokens; a larger one is split again on a token sampled for it, and so on. A bucket that keeps most of
   its sets under a split holds sets that are alike, so all are taken as candidates of one another. A run that ends after L tokens
   meets a pair at the least similarity with a chance of 0.8**L, more or less as its embedded tokens happen to agree. Each set
   counts the depths at which its runs ended; sets whose depths leave a chance above 1 - ``recall`` to miss such a pair go through
   more runs among themselves, until none is left. A pair with one end that has met ``recall`` was in its buckets.
2. Candidates form components, which hold every true link and perhaps more. A component's sets meet in one
   task, or, if they are too many, block by block, and there all true similarities are computed: links are exact, counted per node, and no pair
   leaves the task.
3. Links that hold form the classes.

Joins of large tables are by sorted shuffle whatever the other side's size, so that a plan is the same at every size; Spark splits large
partitions.

Cases: a NULL or empty text has no words, and all such rows are one class; a text under ``n`` words has one gram, all its
words; equal rows are of one class; a NULL id is a member like any other but never names a class that has others;
an empty table gives an empty result. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import kept_at, stored, text_key, whole
from vecshoal.llm.components import components
from vecshoal.session import remove_path

MIX = np.uint64(0xD6E8FEB86659FD93)


class Shingles:
    """Hashed word n-grams of texts in lower case, with a bounded memory of word hashes."""

    def __init__(self, n: int, remember: int = 400_000):
        self.n, self.remember = n, remember
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """The distinct grams, ascending."""
        words = text.lower().split()
        known = self.known
        if len(known) > self.remember:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        grams = np.full(max(0, min(1, len(h)), len(h) - self.n + 1), len(h) if len(h) < self.n else self.n, dtype=np.uint64)
        for word in range(min(self.n, len(h))):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[word : word + len(grams)]
        grams ^= grams >> np.uint64(32)
        grams *= MIX
        return np.unique(grams)


def embed(grams: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The MinHash of a set under each seed."""
    least = np.full(len(seeds), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(grams), 4096):
        x = (grams[at : at + 4096, None] ^ seeds) * MIX
        least = np.minimum(least, (x >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return least


def described(docs: DataFrame, n: int, coordinates: int) -> DataFrame:
    """``doc_id, text_key, sid, grams, tokens``: the hash and size of each row's set, and its embedded tokens."""
    seeds = np.random.default_rng(11).integers(1, 1 << 63, coordinates, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(text) for text in part.column(2).to_pylist()]
                columns = [
                    part.column(0), part.column(1),
                    pa.array([xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63) for grams in sets], type=pa.int64()),
                    pa.array([len(grams) for grams in sets], type=pa.int32()),
                    pa.array([embed(grams, seeds).tobytes() for grams in sets], type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "sid", "grams", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_key(F.col("_text")).alias("text_key"), "_text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, sid long, grams int, tokens binary")


def token(place: Column) -> Column:
    """The embedded token at a coordinate, as bytes."""
    return F.substring("tokens", place * 4 + 1, F.lit(4))


def forest(sids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The least id each id is connected to by the true cells of a square matrix."""
    root = np.arange(len(sids))
    while True:
        nearest = np.where(linked, root[None, :], len(sids)).min(axis=1)
        after = np.minimum(root, nearest)
        after = after[after]
        if (after == root).all():
            return sids[root]
        root = after


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of each key from batches sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        new[0] = key != tuple(column[0] for column in columns)
        starts = np.append(np.flatnonzero(new), batch.num_rows)
        if len(starts) == 1:
            held.append(batch)
            continue
        if starts[0]:
            held.append(batch.slice(0, starts[0]))
        for start, end in zip(starts[:-1], starts[1:]):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(start, end - start)]
        key = tuple(column[-1] for column in columns)
    if held:
        yield pa.Table.from_batches(held)


def rows_of(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(one, dtype=dtype) for one in column.to_pylist()]


def links_in_buckets(buckets: DataFrame, least_share: float, coordinates: int) -> DataFrame:
    """A spanning forest of the likely links in each bucket, by the share of equal tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for table in grouped(batches, 1):
            sids, tokens = table["sid"].to_numpy(), np.stack(rows_of(table["tokens"], np.uint32))
            if len(sids) == 2:
                likely = (tokens[0] == tokens[1]).mean() >= least_share
                a.extend(sids[:1] if likely else ()), b.extend(sids[1:] if likely else ())
                continue
            same = np.zeros((len(sids), len(sids)), dtype=np.int32)
            for column in tokens.T:
                same += column[:, None] == column
            roots = forest(sids, same >= least_share * coordinates)
            a.extend(sids[roots != sids]), b.extend(roots[roots != sids])
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = buckets.select("bucket", "sid", "tokens").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long")


def chance_missed(depths: np.ndarray, threshold: float, coordinates: int, least: int) -> np.ndarray:
    """The chance that runs miss a pair of similarity ``threshold`` of which ``least`` or more tokens are equal.

    A row of ``depths`` has the numbers of runs that ended after 1, 2, ... tokens. The number of equal tokens is binomial.
    """
    equal = np.arange(least, coordinates + 1)
    weights = np.array([math.comb(coordinates, n) * threshold**n * (1 - threshold) ** (coordinates - n) for n in equal.tolist()])
    apart = 1 - (equal[:, None] / coordinates) ** np.arange(1, depths.shape[1] + 1)
    return np.power(apart, depths[:, None, :]).prod(axis=2) @ weights


def least_equal(threshold: float, coordinates: int, recall: float) -> tuple[int, float]:
    """The number of equal tokens from which a pair is likely, and the chance to miss that is left to the runs.

    3.5 deviations below the mean, or less, so that fewer pairs fall below than a quarter of those that may be missed.
    """
    below, share = 0, 0.0
    most = math.ceil(coordinates * (threshold - 3.5 * (threshold * (1 - threshold) / coordinates) ** 0.5))
    while below < most:
        more = share + math.comb(coordinates, below) * threshold**below * (1 - threshold) ** (coordinates - below)
        if more > (1 - recall) / 4:
            break
        below, share = below + 1, more
    return below, 1 - recall - share


def still_open(depths: DataFrame, threshold: float, coordinates: int, least: int, allowed: float) -> DataFrame:
    """The rows of ``sid, depths`` whose runs may miss more than allowed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                missed = chance_missed(np.array(part.column(1).to_pylist()), threshold, coordinates, least)
                yield part.filter(pa.array(missed > allowed))

    return depths.select("sid", "depths").mapInArrow(run, "sid long, depths array<bigint>")


def candidates(
    nodes: DataFrame, threshold: float, coordinates: int, runs: int, brute: int, depth: int, alike: float, recall: float
) -> tuple[DataFrame, list[str]]:
    """Likely links ``a, b`` between nodes: a pair at the similarity ``threshold`` is connected by them with a chance of ``recall``."""
    if not 0 < recall < 1:
        raise ValueError("recall lies between 0 and 1")
    least, allowed = least_equal(threshold, coordinates, recall)
    while chance_missed(np.array([[runs]]), threshold, coordinates, least)[0] > allowed:
        runs += 1
    found: list[DataFrame] = []
    paths: list[str] = []
    among, before, done, more = nodes, None, 0, runs
    while True:
        splits = run_paths(among, nodes, range(done, done + more), least / coordinates, coordinates, brute, depth, alike, found, paths)
        if before is None and not splits:
            break
        now = before
        if splits:
            # A run that was split at a level ended beyond it.
            rows = splits[0]
            for level in splits[1:]:
                rows = rows.unionByName(level)
            passed = [F.count_if(F.col("level") == level).alias(f"split_{level}") for level in range(depth)]
            now = rows.groupBy("sid").agg(*passed)
            now = now if before is None else before.join(now.hint("merge"), "sid", "left")
        at = [F.lit(more), *[F.coalesce(F.col(f"split_{level}"), F.lit(0)) if splits else F.lit(0) for level in range(depth)]]
        earlier = F.array(*[F.lit(0)] * depth) if before is None else F.col("depths")
        ended = F.array(*[(earlier[level] + at[level] - at[level + 1]).cast("long") for level in range(depth)])
        deep, path = kept_at(still_open(now.withColumn("depths", ended), threshold, coordinates, least, allowed), "deep")
        paths.append(path)
        if deep.isEmpty():
            break
        before = deep
        among = nodes.join(deep.select("sid").hint("merge"), "sid")
        done, more = done + more, done + more
    everything = found[0]
    for links in found[1:]:
        everything = everything.unionByName(links)
    return everything, paths


def run_paths(
    among: DataFrame, nodes: DataFrame, runs: range, least_share: float, coordinates: int, brute: int, depth: int, alike: float,
    found: list[DataFrame], paths: list[str],
) -> list[DataFrame]:
    """Some runs over some nodes. Adds links to ``found`` and folders to ``paths``; gives ``sid, level`` of each split."""
    bucket = lambda *of: F.xxhash64(*of).alias("bucket")
    # A run's first token is that of the coordinate of its own number.
    places = [(run, F.lit(run % coordinates)) for run in runs]
    each = F.array(*[F.struct(place.alias("place"), bucket(F.lit(run), token(place))) for run, place in places])
    members = among.select("sid", F.explode(each).alias("at")).select("sid", "at.*", F.lit(None).cast("long").alias("above"))
    splits: list[DataFrame] = []
    for level in range(depth):
        sizes = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("sid").alias("head"), F.max("above").alias("above"))
        similar = F.coalesce(F.col("size") >= alike * F.col("above"), F.lit(False)) | F.lit(level == depth - 1)
        state = F.when(F.col("size") <= brute, "brute").when(similar, "alike").otherwise("split").alias("state")
        sizes = sizes.where("size > 1").select("bucket", "size", "head", state)
        held = members.drop("above").join(sizes.hint("merge"), "bucket")
        if level == 0:
            held = held.join(nodes.hint("merge"), "sid")
        held, path = kept_at(held, "buckets")
        paths.append(path)
        found.append(held.where("state = 'alike' and sid <> head").select(F.col("sid").alias("a"), F.col("head").alias("b")))
        links, path = kept_at(links_in_buckets(held.where("state = 'brute'"), least_share, coordinates), "links")
        paths.append(path)
        found.append(links)
        large = held.where("state = 'split'")
        if large.isEmpty():
            break
        splits.append(large.select("sid", F.lit(level).alias("level")))
        # Any coordinate but that of the split before.
        step = F.pmod(F.xxhash64("bucket", F.lit(5)), F.lit(coordinates - 1)).cast("int")
        large = large.withColumn("place", (F.col("place") + 1 + step) % coordinates)
        members = large.select("sid", "tokens", "place", bucket("bucket", "place", token(F.col("place"))), F.col("size").alias("above"))
    return splits


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, through a matrix of the grams that occur on both sides."""
    if len(left) * len(right) <= 64:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], dtype=np.int64)
    own, other = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(own, other)
    out = np.zeros((len(left), len(right)))

    def cells(sets: list[np.ndarray], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, values)
        inside = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == values) if len(shared) else np.zeros(0, dtype=np.int64)
        by = inside[np.argsort(at[inside], kind="stable")]
        return rows[by], at[by]

    (row_a, col_a), (row_b, col_b) = cells(left, own), cells(right, other)
    for begin in range(0, len(shared), 4096):
        end = min(begin + 4096, len(shared))
        x, y = np.zeros((len(left), end - begin), dtype=np.float32), np.zeros((len(right), end - begin), dtype=np.float32)
        for cellsof, (rows, columns) in ((x, (row_a, col_a)), (y, (row_b, col_b))):
            low, high = np.searchsorted(columns, [begin, end])
            cellsof[rows[low:high], columns[low:high] - begin] = 1
        out += x @ y.T
    return np.rint(out).astype(np.int64)


def true_links(sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b, links`` of the rows of each task key: the least node reached by links there, and the number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3):
            sids, block, own = table["sid"].to_numpy(), table["block"].to_numpy(), rows_of(table["set"], np.uint64)
            i, j = table["i"][0].as_py(), table["j"][0].as_py()
            sizes = np.array([len(s) for s in own])
            if i == j:
                one, two = np.arange(len(sids)), np.arange(len(sids))
            else:
                one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
            common = intersections([own[x] for x in one], [own[x] for x in two])
            alike = common >= threshold * (sizes[one][:, None] + sizes[two] - common) - 1e-9
            linked = np.zeros((len(sids), len(sids)), dtype=bool)
            linked[np.ix_(one, two)] = alike
            linked |= linked.T
            np.fill_diagonal(linked, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids), pa.array(forest(sids, linked)), pa.array(linked.sum(axis=1).astype(np.int64))], names=["a", "b", "links"]
            )

    dealt = sets.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return dealt.mapInArrow(run, "a long, b long, links long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    coordinates: int = 64,
    runs: int = 12,
    brute: int = 200,
    depth: int = 8,
    alike: float = 0.6,
    block_rows: int = 1_500,
    block_grams: int = 3_000_000,
    recall: float = 0.999,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, class_key, class_id, n_links``.

    ``class_id`` is the least id of its class, ``n_links`` the number of other sets of grams within the threshold
    of its own. Documents are in one class if links connect them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("_text"))
    keys, _ = kept_at(described(rows, n, coordinates), "sets")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    nodes, nodes_path = kept_at(
        keys.where("grams > 0").groupBy("sid").agg(F.first("grams").alias("grams"), F.first("tokens").alias("tokens")), "nodes"
    )
    likely, paths = candidates(nodes.select("sid", "tokens"), threshold, coordinates, runs, brute, depth, alike, recall)
    joined, joined_path = components(likely, "candidates")
    for path in paths:
        remove_path(spark, path)

    # The candidates' sets, one document for each.
    member = joined.select(F.col("a").alias("sid"), F.col("b").alias("component"))
    member = member.unionByName(joined.select(F.col("b").alias("sid"), F.col("b").alias("component")).distinct())
    member = member.join(nodes.select("sid", "grams"), "sid")
    blocks = F.ceil(F.greatest(F.count("*") / block_rows, F.sum("grams") / block_grams)).cast("int")
    member = member.join(member.groupBy("component").agg(blocks.alias("blocks")), "component")
    text_of = keys.where("grams > 0").groupBy("sid").agg(least.alias("at")).select("sid", "at.doc_id", "at.text_key")
    wanted, wanted_path = kept_at(member.join(text_of, "sid").drop("grams"), "wanted")

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [shingles(text).tobytes() for text in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, type=pa.binary())], names=["sid", "component", "blocks", "set"])

    texts = rows.withColumn("text_key", text_key(F.col("_text")))
    same = [texts["doc_id"].eqNullSafe(wanted["doc_id"]), texts["text_key"] == wanted["text_key"]]
    sets = texts.join(wanted.hint("merge"), same).select("sid", "component", "blocks", "_text")
    sets = sets.mapInArrow(grams_of, "sid long, component long, blocks int, set binary").dropDuplicates(["sid"])
    own = F.pmod(F.xxhash64("sid", F.lit(3)), F.col("blocks")).cast("int")
    sets = sets.withColumn("block", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.select("component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "sid", "block", "set")
    checked, checked_path = kept_at(true_links(sets, threshold), "checked")
    remove_path(spark, joined_path)
    remove_path(spark, wanted_path)

    classes, classes_path = components(checked.select("a", "b"), "classes")
    links = checked.groupBy(F.col("a").alias("sid")).agg(F.sum("links").alias("n_links"))
    firsts = keys.groupBy("sid").agg(F.min("doc_id").alias("first"))
    named = firsts.join(classes.select(F.col("a").alias("sid"), F.col("b").alias("root")), "sid", "left")
    named = named.withColumn("root", F.coalesce("root", "sid"))
    heads = named.groupBy("root").agg(F.min("first").alias("class_id"))
    told = named.join(heads, "root").join(links, "sid", "left")
    told = told.select("sid", F.col("root").alias("class_key"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    told = stored(told, "classes")
    for path in (checked_path, classes_path, nodes_path):
        remove_path(spark, path)
    return keys.join(told.hint("merge"), "sid").select("doc_id", "text_key", "class_key", "class_id", "n_links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one of each class left: that of the least id, of equal ids that of the least text hash."""
    found = near_duplicates(docs, doc_id, text, **options)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    heads = found.groupBy("class_key").agg(F.min(order).alias("head"))
    heads = heads.select(F.col("head.doc_id").alias("_id"), F.col("head.text_key").alias("_key"))
    # The input's columns travel as one struct, whatever their names.
    keyed = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), text_key(whole(text)).alias("own"))
    kept = keyed.join(heads.hint("merge"), keyed["id"].eqNullSafe(heads["_id"]) & (keyed["own"] == heads["_key"]), "left_semi")
    return kept.dropDuplicates(["id", "own"]).select("doc.*")
