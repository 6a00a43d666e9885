"""Counts, means and spreads, over the table and per cluster.

``Summarizer`` adds whole vectors on the map side, so a cluster of any size reaches its
reducer as one row per task, and no vector is taken apart into rows.
"""

from functools import reduce
from operator import and_

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.functions import vectors
from vecshoal.operators.joins import attach


def cluster_sizes(items: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Rows per cluster, the largest first."""
    counted = items.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("size"))
    return counted.orderBy(F.desc("size"), cluster)


def _moments(items: DataFrame, vector: str, width: int | None, *keys: str) -> DataFrame:
    """``keys`` and the struct ``m`` of count, mean and variance of the vectors of ``width`` finite elements; no group has a NULL key.

    Without ``width`` it is the most common number of elements, the least of equally common ones. One scan serves both: moments are
    added up by width, and the counts in them tell which width it is; the plan uses its one exchange twice.
    """
    size = F.array_size(vector)
    numbers = F.col(vector).cast("array<double>")
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    of = Summarizer.metrics("count", "mean", "variance")
    if width is not None:
        rows = items.where(reduce(and_, [F.col(key).isNotNull() for key in keys], (size == width) & ~broken))
        return rows.groupBy(*keys).agg(of.summary(array_to_vector(F.col(vector))).alias("m"))
    # Broken vectors only count for their width; a stand-in takes their place.
    named = {key: f"_{place}" for place, key in enumerate(keys)}
    rows = items.where(size > 0).select(
        *[F.col(key).alias(name) for key, name in named.items()],
        size.alias("width"),
        broken.alias("broken"),
        numbers.alias("x"),
    )
    rows = rows.withColumn("x", array_to_vector(F.when(F.col("broken"), F.array(F.lit(0.0))).otherwise(F.col("x"))))
    by_width = rows.groupBy(*named.values(), "width", "broken").agg(of.summary(F.col("x")).alias("m"))
    counts = by_width.groupBy("width").agg(F.sum("m.count").alias("n"))
    common = counts.agg(F.max_by("width", F.struct("n", -F.col("width"))).alias("common"))
    # Bound to the count, the choice stays above the sums, so that both uses read the same exchange.
    fits = F.when(reduce(and_, [F.col(name).isNotNull() for name in named.values()], (F.col("m.count") > 0) & ~F.col("broken")), F.col("width"))
    chosen = by_width.withColumn("fits", fits).join(F.broadcast(common), F.col("fits") == F.col("common"))
    return chosen.select(*[F.col(name).alias(key) for key, name in named.items()], "m")


def _population_variance() -> Column:
    """Summarizer divides by n - 1; the scaler of this engine divides by n."""
    n = F.col("m.count")
    return F.transform(vector_to_array("m.variance"), lambda v: v * (n - 1) / n)


def dimension_stats(items: DataFrame, vector: str = "encd", width: int | None = None) -> DataFrame:
    """Mean and population standard deviation of every dimension, one row each; vectors that do not fit are left out."""
    stats = _moments(items, vector, width)
    pairs = F.arrays_zip(
        vector_to_array("m.mean").alias("mean"), F.transform(_population_variance(), F.sqrt).alias("std")
    )
    return stats.select(F.posexplode(pairs).alias("dim", "s")).select(
        "dim", F.col("s.mean").alias("mean"), F.col("s.std").alias("std")
    )


def cluster_centroids(
    items: DataFrame, vector: str = "encd", cluster: str = "cluster_id", width: int | None = None
) -> DataFrame:
    """The mean vector and the size of every cluster; vectors that do not fit are left out."""
    means = _moments(items, vector, width, cluster)
    return means.select(cluster, vector_to_array("m.mean").alias("centroid"), F.col("m.count").alias("size"))


def own_mean_sse(
    items: DataFrame, vector: str = "encd", cluster: str = "cluster_id", width: int | None = None
) -> DataFrame:
    """Sum of squared distances to the cluster's own mean, without a join; vectors that do not fit are left out."""
    spread = vectors.element_sum(_population_variance()) * F.col("m.count")
    groups = _moments(items, vector, width, cluster)
    return groups.select(cluster, F.col("m.count").alias("size"), spread.alias("sse"))


def attach_centroid(items: DataFrame, centroids: DataFrame, cluster: str = "cluster_id", key: str = "id") -> DataFrame:
    """Put the centroid of its cluster on every item as ``cluster_centroid``."""
    named = centroids.select(cluster, F.col("centroid").alias("cluster_centroid"))
    return attach(items, named, cluster, spread=key)


def centroid_sse(items: DataFrame, centroids: DataFrame, vector: str = "encd", cluster: str = "cluster_id") -> DataFrame:
    """Sum of squared distances to given centroids, per cluster; vectors of another width than their centroid are left out."""
    paired = attach_centroid(items.select("id", cluster, vector), centroids, cluster)
    paired = paired.where(F.array_size(vector) == F.array_size("cluster_centroid"))
    away = vectors.squared_distance(F.col(vector), F.col("cluster_centroid"))
    return paired.groupBy(cluster).agg(F.count("*").alias("size"), F.sum(away).alias("sse"))
