"""The two-level index: items listed by mixture group and by cluster inside the group, so that a search reads a few short lists.

A mixture divides the reduced vectors into groups, K-Means each group into clusters: the secondary keys. Items are stored split by
both keys. A query goes to its most likely group and there to the clusters with the nearest centres, as many as asked for; all other
lists are left unread. A group that was not divided is one list.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecshoal.functions.blocks import fitting, list_column
from vecshoal.operators import kmeans, search
from vecshoal.operators.features import FeatureModel
from vecshoal.operators.mixture import Mixture, fit_mixtures, likeliest
from vecshoal.operators.secondary import GROUP_SIZES, fit_secondary
from vecshoal.plans.index import IndexModel, SearchIndex
from vecshoal.session import materialise, remove_path, write_small
from vecshoal.sources.schema import KEYED

KEYS = ("gmm_cluster_id", "secondary_cluster_id")


@dataclass
class KeyedModel:
    """An index model, the mixture over its reduced vectors, and the centres inside each group that was divided."""

    base: IndexModel
    mixture: Mixture
    inside: dict[int, np.ndarray]

    @property
    def features(self) -> FeatureModel:
        return self.base.features

    @property
    def stride(self) -> int:
        """More than any group has lists."""
        return max([1, *(len(own) for own in self.inside.values())])

    def place(self, rows: DataFrame, vector: str = "encd", lists: int = 1) -> DataFrame:
        """Add ``reduced``, ``cluster_id``, ``gmm_cluster_id`` and ``lists``, the numbers of the nearest clusters of the group."""
        (weights, offset), width = self.features.projection(), self.features.width
        centers, terms, inside = self.base.centers, self.mixture.log_terms(), self.inside

        @F.arrow_udf("reduced array<double>, cluster_id int, gmm_cluster_id int, lists array<int>")
        def all_of(column: pa.Array) -> pa.Array:
            ok, found = fitting(column, width)
            reduced = found @ weights - offset
            clusters, groups = kmeans.closest(reduced, centers), likeliest(reduced, terms)
            nearest = np.full((len(reduced), lists), -1)
            for group in np.unique(groups):
                at = np.flatnonzero(groups == group)
                own = inside.get(int(group))
                if own is None:
                    nearest[at, 0] = 0
                else:
                    near = kmeans.closest_few(reduced[at], own, lists)
                    nearest[at, : near.shape[1]] = near
            used = nearest >= 0
            ends = np.zeros(len(ok) + 1, dtype=np.int32)
            ends[1:][ok] = used.sum(axis=1)
            ends = np.cumsum(ends).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(nearest[used].astype(np.int32)), mask=pa.array(~ok))
            whole = np.zeros((2, len(ok)), dtype=np.int32)
            whole[0, ok], whole[1, ok] = clusters, groups
            parts = [list_column(reduced, ok), *(pa.array(x, mask=~ok) for x in whole), listed]
            return pa.StructArray.from_arrays(parts, names=["reduced", "cluster_id", "gmm_cluster_id", "lists"])

        placed = rows.withColumn("_placed", all_of(vector))
        return placed.withColumns({n: F.col(f"_placed.{n}") for n in ("reduced", "cluster_id", "gmm_cluster_id", "lists")}).drop("_placed")

    def label(self, items: DataFrame, arranged: bool = False) -> DataFrame:
        """Items in the stored layout with all keys; an item whose vector does not fit stays, without any."""
        named = kmeans.centroid_table(items.sparkSession, self.base.centers).withColumnRenamed("centroid", "cluster_centroid")
        placed = self.place(items).withColumn("secondary_cluster_id", F.get("lists", F.lit(0)))
        if arranged:
            placed = placed.hint("rebalance", *KEYS)
        # One row per centre, at most as many as the model holds.
        return placed.join(F.broadcast(named), "cluster_id", "left").select(*KEYED.names)

    def save(self, spark: SparkSession, path: str) -> None:
        self.base.save(spark, path)
        self.mixture.save(spark, f"{path}/mixture")
        rows = [(group, i, center.tolist()) for group, own in sorted(self.inside.items()) for i, center in enumerate(own)]
        write_small(spark, rows, "gmm_cluster_id int, secondary_cluster_id int, centroid array<double>", f"{path}/inside")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "KeyedModel":
        inside: dict[int, list] = {}
        for row in spark.read.parquet(f"{path}/inside").orderBy(*KEYS).collect():
            inside.setdefault(row.gmm_cluster_id, []).append(row.centroid)
        return KeyedModel(IndexModel.load(spark, path), Mixture.load(spark, f"{path}/mixture"), {g: np.array(own) for g, own in inside.items()})


def fit_keys(
    items: DataFrame,
    base: IndexModel,
    components: int = 4,
    sizes: list[int] = GROUP_SIZES,
    without_elbow: int | None = None,
    restarts: int = 10,
    max_iter: int = 300,
    seed: int = 42,
) -> KeyedModel:
    """Mixture groups of the reduced items, and in each the sweep, its elbow and the fit, all groups at once."""
    points, path = materialise(items.select(base.features.project("encd").alias("reduced")), "reduced")
    try:
        mixture = fit_mixtures(points, [components], width=base.features.kept)[0]
        grouped = points.withColumn("gmm_cluster_id", mixture.label("reduced"))
        keys = fit_secondary(grouped, "gmm_cluster_id", sizes, "reduced", restarts, max_iter, seed, without_elbow)
        return KeyedModel(base, mixture, keys.centers)
    finally:
        remove_path(items.sparkSession, path)


class KeyedIndex(SearchIndex):
    """A two-level model and the items it labelled, stored split by both keys."""

    model_type = KeyedModel
    schema = KEYED
    partition = KEYS

    def search(self, queries: DataFrame, k: int = 20, space: str = "reduced", keep=search.ITEM_COLUMNS, lists: int = 1) -> DataFrame:
        """The k most similar items of the ``lists`` nearest lists of each query ``(query_id, encd)``.

        A list is one number, made of both keys, for items and queries alike. It is made of nothing else, so that Spark prunes
        folders by it. A query of several lists is asked once for each, and its answers are ranked together.
        """
        vector, width = self.model.features.space(space)
        good, _ = search.split_vector_queries(queries, self.model.features.width)
        stride = self.model.stride
        asked = self.model.place(good, lists=lists).withColumn("list", F.explode("lists")).drop("cluster_id")
        asked = asked.withColumn("cluster_id", F.col(KEYS[0]) * stride + F.col("list"))
        items = self.table.read().withColumn("cluster_id", F.col(KEYS[0]) * stride + F.col(KEYS[1]))
        if lists == 1:
            return search.top_k(items, asked, k, vector, keep, width, checked=True)
        kind = queries.schema["query_id"].dataType
        asked = asked.withColumn("query_id", F.concat_ws(":", "list", "query_id"))
        found = search.top_k(items, asked, k, vector, keep, width, checked=True)
        found = found.withColumn("query_id", F.expr("substring(query_id, locate(':', query_id) + 1)").cast(kind))
        place = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "id", *keep, "similarity")

    def search_one(self, query, k: int = 20, lists: int = 1) -> DataFrame:
        """The same for one vector given as a Python sequence."""
        return self.search(self._one_query(query), k, lists=lists).drop("query_id")
