"""Secondary keys: further clusters inside each group of a first clustering."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.functions.blocks import fitting
from vecshoal.operators import kmeans
from vecshoal.operators.elbow import elbows

# The model sizes swept inside a group: 1, 4, ..., 49.
GROUP_SIZES = list(range(1, 50, 3))


@dataclass
class SecondaryKeys:
    """Sweep table, elbow per group, and the chosen centres per group."""

    sweep: DataFrame
    elbow: DataFrame
    centers: dict[int, np.ndarray]

    def label(self, points: DataFrame, group: str, vector: str = "reduced") -> DataFrame:
        """Add ``secondary_cluster_id``; NULL in a group without centres, and for a vector that does not fit."""
        centers = self.centers

        @F.arrow_udf("int")
        def inside(groups: pa.Array, column: pa.Array) -> pa.Array:
            out = np.full(len(groups), -1, dtype=np.int32)
            number = groups.fill_null(-1).to_numpy(zero_copy_only=False)
            for g, own in centers.items():
                at = np.flatnonzero(number == g)
                if len(at):
                    ok, rows = fitting(column.take(pa.array(at)), own.shape[1])
                    out[at[ok]] = kmeans.closest(rows, own)
            return pa.array(out, mask=out < 0)

        return points.withColumn("secondary_cluster_id", inside(F.col(group).cast("int"), F.col(vector)))


def fit_secondary(
    points: DataFrame,
    group: str,
    sizes: list[int] = GROUP_SIZES,
    vector: str = "reduced",
    restarts: int = 10,
    max_iter: int = 300,
    seed: int = 42,
    without_elbow: int | None = None,
    starts: dict[tuple[int, int], np.ndarray] | None = None,
) -> SecondaryKeys:
    """Sweep, elbow and fit inside every group at once.

    ``starts`` gives the first centres of each group and size, instead of ``sizes`` and ``restarts``.
    A group whose curve has no elbow gets ``without_elbow`` clusters (the next size swept), or
    none at all. No group is moved or gathered: its rows are folded wherever they lie.
    """
    spark = points.sparkSession
    if starts is not None:
        fits = kmeans.fit_given(points, starts, vector, group, max_iter=max_iter)
    else:
        fits = kmeans.fit_many(points, sizes, vector, group, restarts=restarts, max_iter=max_iter, seed=seed)
    best = kmeans.best_fits(fits)
    sweep = kmeans.sweep_table(spark, best, group)
    elbow = elbows(sweep, curve=group)
    centers = {}
    for row in elbow.collect():
        swept = [k for g, k in best if g == row[group]]
        k = row.elbow
        if k is None and without_elbow is not None:
            k = max((s for s in swept if s <= without_elbow), default=min(swept))
        if k is not None:
            centers[row[group]] = best[row[group], k].centers
    return SecondaryKeys(sweep, elbow, centers)
