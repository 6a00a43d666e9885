"""Standardise and reduce vectors: the scaler and the principal components in one pass.

Means, deviations and components all follow from the sums of ``z z^T`` with ``z = (1, x)``.
Tasks add these sums up a block at a time, so the table is read once; the decomposition of
one ``width x width`` matrix is left to the driver. Columns that nearly depend on one another lose half their digits
in such products; triangular factors, merged two by two, keep them, but take a task about ten times as long.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecshoal.functions.blocks import count_widths, fitting, map_vectors
from vecshoal.operators.partials import DIRECT_BYTES, fewer_tasks, most_common, sum_over_tasks
from vecshoal.session import small_table, write_small


@dataclass
class FeatureModel:
    """A fitted scaler and principal components, of which the first ``kept`` are used."""

    mean: np.ndarray
    deviation: np.ndarray
    loadings: np.ndarray
    ratio: np.ndarray
    kept: int
    rows: int
    left_out: int = 0

    @property
    def width(self) -> int:
        return len(self.mean)

    def space(self, name: str) -> tuple[str, int]:
        """Column and width of the vectors of a space: ``reduced`` (standardised and projected) or ``raw``."""
        return {"reduced": ("reduced", self.kept), "raw": ("encd", self.width)}[name]

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        """``weights`` and ``offset`` such that ``x @ weights - offset`` is standardised and reduced."""
        scale = np.where(self.deviation > 0, self.deviation, 1.0)
        weights = self.loadings[: self.kept].T / scale[:, None]
        return weights, self.mean @ weights

    def project(self, vector: Column | str) -> Column:
        """Standardised and reduced vector; NULL for a vector that does not fit."""
        (weights, offset), width = self.projection(), self.width

        @F.arrow_udf("array<double>")
        def reduce(column: pa.Array) -> pa.Array:
            return map_vectors(column, width, lambda rows: rows @ weights - offset)

        return reduce(vector)

    def standardise(self, vector: Column | str) -> Column:
        scale = np.where(self.deviation > 0, self.deviation, 1.0)
        mean, width = self.mean, self.width

        @F.arrow_udf("array<double>")
        def scaled(column: pa.Array) -> pa.Array:
            return map_vectors(column, width, lambda rows: (rows - mean) / scale)

        return scaled(vector)

    def keep(self, share: float | None = 0.95, components: int | None = None) -> "FeatureModel":
        """The same fit with another number of components: a count, or a share of variance."""
        count = components if components is not None else component_count(self.ratio, share)
        return FeatureModel(self.mean, self.deviation, self.loadings, self.ratio, count, self.rows, self.left_out)

    def variance_curve(self, spark: SparkSession) -> DataFrame:
        """Explained-variance ratio per component and its running total."""
        rows = [(i + 1, float(r)) for i, r in enumerate(self.ratio)]
        curve = small_table(spark, rows, "component int, ratio double").withColumn("curve", F.lit(1))
        running = Window.partitionBy("curve").orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
        return curve.withColumn("cumulative", F.sum("ratio").over(running)).drop("curve")

    def save(self, spark: SparkSession, path: str) -> None:
        """Two small tables: the scaler by dimension, and one row per component."""
        scaler = [(i, float(m), float(s)) for i, (m, s) in enumerate(zip(self.mean, self.deviation))]
        parts = [
            (i, float(r), i < self.kept, self.rows, self.left_out, vector.tolist())
            for i, (r, vector) in enumerate(zip(self.ratio, self.loadings))
        ]
        write_small(spark, scaler, "dim int, mean double, deviation double", f"{path}/scaler")
        schema = "component int, ratio double, kept boolean, rows long, left_out long, loading array<double>"
        write_small(spark, parts, schema, f"{path}/components")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureModel":
        scaler = spark.read.parquet(f"{path}/scaler").orderBy("dim").collect()
        parts = spark.read.parquet(f"{path}/components").orderBy("component").collect()
        return FeatureModel(
            np.array([r.mean for r in scaler]),
            np.array([r.deviation for r in scaler]),
            np.array([r.loading for r in parts]),
            np.array([r.ratio for r in parts]),
            sum(r.kept for r in parts),
            parts[0]["rows"],
            parts[0].left_out,
        )


def component_count(ratio: np.ndarray, share: float) -> int:
    """The fewest leading components whose ratios add up to more than ``share``."""
    return min(int((np.cumsum(ratio) <= share).sum()) + 1, len(ratio))


def _sums(rows: DataFrame, origin: np.ndarray) -> tuple[np.ndarray, Counter]:
    """The sum of ``z z^T`` over the vectors as wide as ``origin``, ``z`` being 1 and their difference from it, and the count of every width."""
    width = len(origin)

    def fold(batches, state, widths):
        for batch in batches:
            count_widths(batch.column(0), widths)
            x = fitting(batch.column(0), width)[1] - origin
            z = np.hstack([np.ones((len(x), 1)), x])
            state += z.T @ z

    return sum_over_tasks(rows, fold, width + 1, width + 1)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of a matrix: as many columns, no more rows than columns, and the same inner products."""
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def _factor(rows: DataFrame, origin: np.ndarray) -> tuple[int, np.ndarray, Counter]:
    """Row count and triangular factor of all ``z`` of :func:`_sums`, and the count of every width.

    A task folds its rows into a triangle, some blocks at a time, and triangles meet in a tree; no table of products is made.
    """
    width = len(origin)
    enough = 4 * (width + 1)

    def partial(batches):
        held, waiting, lines, found, widths = np.zeros((0, width + 1)), 0, [], 0, Counter()
        for batch in batches:
            count_widths(batch.column(0), widths)
            x = fitting(batch.column(0), width)[1] - origin
            found += len(x)
            lines.append(np.hstack([np.ones((len(x), 1)), x]))
            waiting += len(x)
            if waiting >= enough:
                held, waiting, lines = _triangle(np.vstack([held, *lines])), 0, []
        held = _triangle(np.vstack([held, *lines]))
        sizes = pa.array([[[wide, count] for wide, count in widths.items()]], pa.list_(pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([pa.array([found]), sizes, pa.array([held.tobytes()], pa.binary())], names=["n", "widths", "held"])

    def state(row):
        return row.n, np.frombuffer(row.held).reshape(-1, width + 1), Counter(dict(map(tuple, row.widths)))

    def merge(a, b):
        return a[0] + b[0], _triangle(np.vstack([a[1], b[1]])), a[2] + b[2]

    partials = fewer_tasks(rows).mapInArrow(partial, "n long, widths array<array<long>>, held binary").rdd.map(state)
    # Few small triangles are merged by the driver; otherwise tasks merge them, a square root of their number each.
    depth = 1 if partials.getNumPartitions() * (width + 1) ** 2 * 8 <= DIRECT_BYTES else 2
    return partials.treeReduce(merge, depth)


def fit_features(
    items: DataFrame,
    vector: str = "encd",
    width: int | None = None,
    share: float | None = 0.95,
    components: int | None = None,
    factors: bool = False,
) -> FeatureModel:
    """Fit scaler and components on the rows whose vector has ``width`` finite elements.

    Without ``width`` it is the most common one of all vectors. The model's ``left_out`` counts the other rows. One scan sums up
    the vectors as wide as the first sound one and counts all widths; only if another width is more common a second scan follows.
    ``factors`` works by triangular factors instead of sums of products: the least components are then known to all digits that the
    vectors have, also where columns nearly depend on one another.
    """
    rows = items.select(vector)
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    wanted = width
    while True:
        sized = F.array_size(vector) > 0 if wanted is None else F.array_size(vector) == wanted
        first = rows.where(sized & sound).first()
        if first is None:
            raise ValueError("no vector to fit on")
        # Any row near the data will do: sums of differences from it lose no digits.
        origin = np.array(first[0], dtype=np.float64)
        if factors:
            n, triangle, widths = _factor(rows, origin)
        else:
            total, widths = _sums(rows, origin)
        common = most_common(widths)
        if width is not None or common == len(origin):
            break
        wanted = common
    width, everyone = len(origin), sum(widths.values())
    if factors:
        shifted, deviation, values, loadings = _by_factor(n, triangle)
    else:
        n = int(round(total[0, 0]))
        shifted, deviation, values, loadings = _by_sums(n, total)
    # Directions have no natural sign; make the largest loading positive.
    peak = np.abs(loadings).argmax(axis=1)
    loadings = loadings * np.sign(loadings[np.arange(width), peak])[:, None]
    ratio = values / max(values.sum(), 1e-300)
    model = FeatureModel(origin + shifted, deviation, loadings, ratio, width, n, everyone - n)
    return model.keep(share, components)


def _by_sums(n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean, deviation, component variances and loadings from the sum of all ``z z^T``."""
    shifted = total[0, 1:] / n
    covariance = total[1:, 1:] / n - np.outer(shifted, shifted)
    variance = np.diagonal(covariance).copy()
    # A constant dimension leaves rounding noise, which must not be blown up to variance 1.
    variance[variance <= 1e-13 * np.maximum(np.diagonal(total)[1:] / n, 1e-300)] = 0.0
    deviation = np.sqrt(variance)
    scale = np.where(deviation > 0, deviation, np.inf)
    values, directions = np.linalg.eigh(covariance / np.outer(scale, scale))
    return shifted, deviation, np.clip(values[::-1], 0.0, None), directions[:, ::-1].T


def _by_factor(n: int, triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same from the triangular factor of all ``z``: its first row holds the sums, the others are the factor of the centred rows."""
    shifted = triangle[0, 1:] / triangle[0, 0]
    centred = triangle[1:, 1:] / np.sqrt(n)
    deviation = np.sqrt((centred**2).sum(axis=0))
    deviation[deviation <= 1e-13 * np.maximum(np.hypot(deviation, shifted), 1e-300)] = 0.0
    scaled = centred / np.where(deviation > 0, deviation, np.inf)
    # With fewer rows than columns the remaining directions have no variance.
    scaled = np.vstack([scaled, np.zeros((max(0, scaled.shape[1] - len(scaled)), scaled.shape[1]))])
    _, lengths, loadings = np.linalg.svd(scaled)
    return shifted, deviation, lengths**2, loadings
