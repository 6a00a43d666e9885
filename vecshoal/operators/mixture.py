"""Gaussian mixtures with full covariance, fitted by EM in log space.

Densities of wide vectors underflow, so responsibilities are formed from log densities. All
model sizes are fitted together: one pass over the table is one round of every open model.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.functions.blocks import label_vectors
from vecshoal.operators import kmeans, partials
from vecshoal.operators.partials import Blocks, batches_of, working_copy
from vecshoal.session import small_table, write_small


START_MOVES = 5


@dataclass
class Mixture:
    """Weights, means and covariances of one model; ``log_likelihood`` is the total over the rows."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = float("nan")
    rows: int = 0
    rounds: int = 0
    converged: bool = False

    @property
    def size(self) -> int:
        return len(self.weights)

    @property
    def parameters(self) -> int:
        k, d = self.means.shape
        return (k - 1) + k * d + k * d * (d + 1) // 2

    @property
    def aic(self) -> float:
        return 2 * self.parameters - 2 * self.log_likelihood

    @property
    def bic(self) -> float:
        return self.parameters * np.log(self.rows) - 2 * self.log_likelihood

    def log_terms(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whitening matrices, whitened means, and the constant of each log density with its weight."""
        width = self.means.shape[1]
        lower = np.linalg.cholesky(self.covariances)
        whiten = np.linalg.inv(lower).transpose(0, 2, 1)
        centre = np.einsum("kd,kde->ke", self.means, whiten)
        half_log_det = np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(axis=1)
        with np.errstate(divide="ignore"):
            constant = np.log(self.weights) - half_log_det - 0.5 * width * np.log(2 * np.pi)
        return whiten, centre, constant

    def label(self, vector: Column | str) -> Column:
        """The most likely component of each row."""
        terms, width = self.log_terms(), self.means.shape[1]

        @F.arrow_udf("int")
        def component(column: pa.Array) -> pa.Array:
            return label_vectors(column, width, lambda rows: likeliest(rows, terms))

        return component(vector)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (i, float(self.weights[i]), self.means[i].tolist(), self.covariances[i].ravel().tolist(),
             self.log_likelihood, self.rows)
            for i in range(self.size)
        ]
        schema = "component int, weight double, mean array<double>, covariance array<double>, log_likelihood double, rows long"
        write_small(spark, rows, schema, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Mixture":
        rows = spark.read.parquet(path).orderBy("component").collect()
        width = len(rows[0].mean)
        return Mixture(
            np.array([r.weight for r in rows]),
            np.array([r.mean for r in rows]),
            np.array([r.covariance for r in rows]).reshape(-1, width, width),
            rows[0].log_likelihood,
            rows[0].rows,
        )


def likeliest(x: np.ndarray, terms) -> np.ndarray:
    """The most likely component of every row of a matrix."""
    return _joint(x, terms).argmax(axis=1)


def _joint(x: np.ndarray, terms) -> np.ndarray:
    """Log of weight times density, one column per component."""
    whiten, centre, constant = terms
    out = np.empty((len(x), len(constant)))
    for i in range(len(constant)):
        away = x @ whiten[i]
        away -= centre[i]
        out[:, i] = constant[i] - 0.5 * np.einsum("ij,ij->i", away, away)
    return out


def _shares(x: np.ndarray, terms) -> tuple[np.ndarray, np.ndarray]:
    """Responsibilities and the log likelihood of every row."""
    joint = _joint(x, terms)
    peak = joint.max(axis=1, keepdims=True)
    raised = np.exp(joint - peak)
    total = raised.sum(axis=1, keepdims=True)
    return raised / total, (peak + np.log(total))[:, 0]


def _hard_shares(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of a row to its nearest centre."""
    chosen = (0.5 * (centers**2).sum(axis=1) - x @ centers.T).argmin(axis=1)
    share = np.zeros((len(x), len(centers)))
    share[np.arange(len(x)), chosen] = 1.0
    return share, np.zeros(len(x))


def _add_block(x: np.ndarray, given: np.ndarray, rule, size: int, state: np.ndarray) -> None:
    """Add to ``state`` the sums of ``r z z^T`` with ``z = (1, x)`` per component, and the log likelihood.

    A rule says how a row is shared out: ``("soft", terms)``, ``("hard", centres)``, or
    ``("given", None)`` where the table itself names the component a row starts in.
    """
    kind, detail = rule
    if kind == "soft":
        share, likely = _shares(x, detail)
    elif kind == "hard":
        share, likely = _hard_shares(x, detail)
    else:
        share, likely = np.eye(size)[given], np.zeros(len(x))
    z = np.hstack([np.ones((len(x), 1)), x])
    side = z.shape[1]
    for i in range(size):
        state[i * side : (i + 1) * side] += (z * share[:, i : i + 1]).T @ z
    state[size * side, 0] += likely.sum()


def _one_round(blocks: Blocks, runs: list["_Run"], origin: np.ndarray) -> list[np.ndarray]:
    """The sums of the models, in one pass over the rows."""
    ends = np.cumsum([run.slots(blocks.width) for run in runs])
    rules = [(run.rule, run.size) for run in runs]

    def fold(held, state):
        for given, x in held:
            for at in range(0, len(x), 4096):
                part = x[at : at + 4096] - origin
                for (rule, size), sums in zip(rules, np.split(state, ends[:-1])):
                    _add_block(part, given[at : at + 4096], rule, size, sums)

    return np.split(blocks.total(fold, int(ends[-1]), blocks.width + 1), ends[:-1])


@dataclass
class _Run:
    """One model on its way: how rows are shared out next, and the likelihood of the last round."""

    size: int
    rule: tuple
    rows: int
    reg: float
    tol: float
    max_iter: int
    model: Mixture | None = None
    last: float = -np.inf

    def slots(self, width: int) -> int:
        return self.size * (width + 1) + 1

    def absorb(self, state: np.ndarray) -> bool:
        """Take in the sums of one round; True once the final parameters are measured."""
        side = state.shape[1]
        block, total = state[:-1].reshape(self.size, side, side), float(state[-1, 0])
        before = self.model
        if before is not None and (before.converged or before.rounds >= self.max_iter):
            before.log_likelihood = total
            return True
        self.model = _maximise(block, self.rows, self.reg)
        if before is not None:
            self.model.rounds = before.rounds + 1
            self.model.converged = abs(total / self.rows - self.last) < self.tol
            self.last = total / self.rows
        self.rule = ("soft", self.model.log_terms())
        return False


def _maximise(block: np.ndarray, n: int, reg: float) -> Mixture:
    """Parameters from the sums of one round."""
    held = block[:, 0, 0] + 10 * np.finfo(float).eps
    means = block[:, 0, 1:] / held[:, None]
    spread = block[:, 1:, 1:] / held[:, None, None] - np.einsum("ki,kj->kij", means, means)
    spread = 0.5 * (spread + spread.transpose(0, 2, 1))
    return Mixture(held / n, means, spread + reg * np.eye(means.shape[1]), rows=n)


def fit_mixtures(
    points: DataFrame,
    sizes: list[int],
    vector: str = "reduced",
    start: str | None = None,
    tol: float = 1e-3,
    reg: float = 1e-6,
    max_iter: int = 100,
    restarts: int = 1,
    seed: int = 0,
    width: int | None = None,
) -> list[Mixture]:
    """Fit one mixture per size, all in the same passes.

    Each starts from a few moves of K-Means with spread starts, or from the component number in the column ``start``.
    A model stops when its mean log likelihood changes by less than ``tol``. Vectors that have not ``width`` finite elements
    (default: the most common number) are left out. ``points`` is read into a copy that the executors keep.
    """
    with working_copy(kmeans.grouped(points, vector, start), width) as blocks:
        facts = kmeans.group_facts(blocks)
        n = sum(fact.rows for fact in facts.values())
        if start is None:
            if n < max(sizes):
                raise ValueError(f"fewer rows than {max(sizes)} components")
            # Clusters to start from need no more than a few moves: the rounds of EM move them on.
            spread = [(r, k, rows) for r in range(restarts) for k, rows in kmeans.spread_starts(blocks, sizes, seed + r).items()]
            best = kmeans.best_fits(kmeans.run_lloyd(blocks, [kmeans.Fit(0, k, r, rows) for r, k, rows in spread], START_MOVES))
        if not n:
            raise ValueError("no vector to fit on")
        origin = sum(fact.rows / n * fact.mean for fact in facts.values())
        rules = [("given", None) if start else ("hard", best[0, size].centers - origin) for size in sizes]
        runs = [_Run(size, rule, n, reg, tol, max_iter) for size, rule in zip(sizes, rules)]
        going = runs
        while going:
            still = []
            for some in batches_of(going, lambda run: run.slots(blocks.width) * (blocks.width + 1) * 8, partials.STATE_BYTES):
                sums = _one_round(blocks, some, origin)
                still += [run for run, state in zip(some, sums) if not run.absorb(state)]
            going = still
    models = [run.model for run in runs]
    for model in models:
        model.means = model.means + origin
    return models


def criteria_table(spark: SparkSession, models: list[Mixture]) -> DataFrame:
    """``(n_components, log_likelihood, bic, aic)``, one row per model."""
    rows = [(m.size, m.log_likelihood, float(m.bic), float(m.aic)) for m in models]
    return small_table(spark, rows, "n_components int, log_likelihood double, bic double, aic double")
