"""The search index: fit, store, load, and answer queries."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.functions.blocks import fitting, list_column
from vecshoal.operators import kmeans, search
from vecshoal.operators.elbow import elbows
from vecshoal.operators.features import FeatureModel, fit_features
from vecshoal.session import materialise, remove_path, small_table, write_small
from vecshoal.sources.items import defect
from vecshoal.sources.schema import CLUSTERED, INDEXED
from vecshoal.sources.store import ItemTable, last_wins

# The model sizes swept over the whole table: 1, 4, ..., 100.
SIZES = list(range(1, 103, 3))


@dataclass
class IndexModel:
    """Scaler, components and centres: all that a query needs to find its cluster."""

    features: FeatureModel
    centers: np.ndarray
    sweep: dict[tuple[int, int], float]

    def place(self, rows: DataFrame, vector: str = "encd") -> DataFrame:
        """Add the ``reduced`` vector and the ``cluster_id`` of its nearest centre, both from one call."""
        (weights, offset), width, centers = self.features.projection(), self.features.width, self.centers

        @F.arrow_udf("reduced array<double>, cluster_id int")
        def both(column: pa.Array) -> pa.Array:
            ok, found = fitting(column, width)
            reduced = found @ weights - offset
            labels = np.zeros(len(ok), dtype=np.int32)
            labels[ok] = kmeans.closest(reduced, centers)
            parts = [list_column(reduced, ok), pa.array(labels, mask=~ok)]
            return pa.StructArray.from_arrays(parts, names=["reduced", "cluster_id"])

        placed = rows.withColumn("_placed", both(vector))
        return placed.withColumns({name: F.col(f"_placed.{name}") for name in ("reduced", "cluster_id")}).drop("_placed")

    def label(self, items: DataFrame, arranged: bool = False) -> DataFrame:
        """Items in the stored layout, with their cluster, its centroid and the reduced vector.

        An item whose vector does not fit the model stays, without a cluster. ``arranged`` gathers
        the rows of a cluster first, so that centroids are added after the shuffle.
        """
        centroids = kmeans.centroid_table(items.sparkSession, self.centers)
        named = centroids.withColumnRenamed("centroid", "cluster_centroid")
        placed = self.place(items)
        if arranged:
            placed = placed.hint("rebalance", "cluster_id")
        # One row per centre, at most as many as the model holds.
        return placed.join(F.broadcast(named), "cluster_id", "left").select(*INDEXED.names)

    def save(self, spark: SparkSession, path: str) -> None:
        self.features.save(spark, f"{path}/features")
        centers = [(i, center.tolist()) for i, center in enumerate(self.centers)]
        write_small(spark, centers, "cluster_id int, centroid array<double>", f"{path}/centroids")
        write_small(spark, [(k, s) for (_, k), s in sorted(self.sweep.items())], "k int, sse double", f"{path}/sweep")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IndexModel":
        centroids = spark.read.parquet(f"{path}/centroids").orderBy("cluster_id").collect()
        sweep = {(0, r.k): r.sse for r in spark.read.parquet(f"{path}/sweep").collect()}
        return IndexModel(FeatureModel.load(spark, f"{path}/features"), np.array([r.centroid for r in centroids]), sweep)


def fit_index(
    items: DataFrame,
    k: int | None = None,
    sizes: list[int] = SIZES,
    without_elbow: int | None = None,
    width: int | None = None,
    share: float = 0.95,
    restarts: int = 10,
    max_iter: int = 300,
    seed: int = 42,
    components: int | None = None,
    starts: dict[int, np.ndarray] | None = None,
) -> IndexModel:
    """Standardise, reduce to ``share`` of the variance (or to ``components``), sweep, take the elbow, and fit.

    ``starts`` gives for each size vectors to start its centres from, instead of ``sizes`` and ``restarts``. ``k`` skips the sweep. A curve without an elbow takes ``without_elbow``, or is an error.
    """
    features = fit_features(items, "encd", width, None if components is not None else share, components)
    points, path = materialise(items.select("id", features.project("encd").alias("reduced")), "reduced")
    try:
        grid = [k] if k is not None else sizes
        if starts is not None:
            weights, offset = features.projection()
            given = {(0, size): np.asarray(rows) @ weights - offset for size, rows in starts.items() if k in (None, size)}
            fits = kmeans.fit_given(points, given, max_iter=max_iter)
        else:
            fits = kmeans.fit_many(points, grid, restarts=restarts, max_iter=max_iter, seed=seed, width=features.kept)
        best = kmeans.best_fits(fits)
        if k is None:
            row = elbows(kmeans.sweep_table(items.sparkSession, best)).first()
            k = row.elbow if row is not None else None
            if k is None and without_elbow is not None:
                k = max((size for _, size in best if size <= without_elbow), default=None)
        if (0, k) not in best:
            raise ValueError(f"no fit to choose: k is {k}, fitted sizes are {sorted(size for _, size in best)}")
        return IndexModel(features, best[0, k].centers, {key: fit.sse for key, fit in best.items()})
    finally:
        remove_path(items.sparkSession, path)


class SearchIndex:
    """A model and the items it labelled, stored under one folder and split by cluster."""

    model_type = IndexModel
    schema = INDEXED
    partition: tuple[str, ...] = ("cluster_id",)

    def __init__(self, spark: SparkSession, path: str, model: IndexModel):
        self.spark = spark
        self.path = path
        self.model = model
        self.table = ItemTable(spark, f"{path}/items", self.schema, self.partition)

    @classmethod
    def build(cls, items: DataFrame, path: str, model: IndexModel, order: list[str] | None = None) -> "SearchIndex":
        """Store all items with their cluster. Rows without an id are set aside; ``order`` tells which row of a repeated id is
        the latest, and without it a repeated id is refused: all its rows are set aside.
        """
        index = cls(items.sparkSession, path, model)
        model.save(items.sparkSession, path)
        index.table.replace(index._labelled(index._one_per_id(items, order), arranged=True), arranged=True)
        return index

    def _labelled(self, items: DataFrame, arranged: bool = False) -> DataFrame:
        """Items in the stored layout."""
        return self.model.label(items, arranged)

    def _one_per_id(self, items: DataFrame, order: list[str] | None) -> DataFrame:
        """Items that can be stored; the others are set aside, those without an id before any order is looked at."""
        self.table.set_aside(items.where(F.col("id").isNull()))
        named = items.where(F.col("id").isNotNull())
        if order is not None:
            return last_wins(named, order)
        repeated = named.groupBy("id").count().where("count > 1").select("id")
        self.table.set_aside(named.join(repeated, "id", "left_semi"))
        return named.join(repeated, "id", "left_anti")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "SearchIndex":
        return cls(spark, path, cls.model_type.load(spark, path))

    def upsert(self, items: DataFrame, order: list[str] | None) -> int:
        """Label new items with the fitted model and replace those of the same id."""
        columns = ["id", "dataset", "url", "encd", "img_name"]
        return self.table.upsert(self._labelled(self._one_per_id(items, order).select(*columns)), None)

    def rejected(self) -> DataFrame:
        """Items no search can find, with the reason: those without a fitting vector or an id, or of a repeated id."""
        lost = self.table.read().where(F.col("cluster_id").isNull()).unionByName(self.table.rejected())
        reason = F.coalesce(defect(self.model.features.width), F.lit("repeated id"))
        return lost.select(*CLUSTERED.names, reason.alias("reason"))

    def refused(self, queries: DataFrame) -> DataFrame:
        """The vector queries that :meth:`search` does not answer, with the reason."""
        return search.split_vector_queries(queries, self.model.features.width)[1]

    def search(self, queries: DataFrame, k: int = 20, space: str = "reduced", keep=search.ITEM_COLUMNS) -> DataFrame:
        """The k most similar items of the cluster of each query ``(query_id, encd)``.

        ``space`` is ``reduced`` (standardised and projected) or ``raw``.
        """
        vector, width = self.model.features.space(space)
        good, _ = search.split_vector_queries(queries, self.model.features.width)
        return search.top_k(self.table.read(), self.model.place(good), k, vector, keep, width, checked=True)

    def search_one(self, query, k: int = 20) -> DataFrame:
        """The same for one vector given as a Python sequence."""
        return self.search(self._one_query(query), k).drop("query_id")

    def _one_query(self, query) -> DataFrame:
        return small_table(self.spark, [(0, [float(v) for v in query])], "query_id long, encd array<double>")
