"""K-Means: many fits in one scan, and nearest-centroid assignment.

A sweep needs hundreds of fits (every k, every restart, and for secondary keys every group).
Run one after another each of them would read the table once per iteration. Here one pass
serves a whole iteration of all fits that have not converged yet, so a sweep passes over the table
as often as its slowest fit does. Starts are drawn from all rows, and a centre that loses its rows
moves to the farthest of all rows. After its first passes a fit keeps marks beside the rows, by which the
triangle inequality tells the rows whose centre cannot have changed; only the others are compared with the centres.
Rows are compared in single precision, and again in double precision where rounding could hide the nearest centre.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.functions.blocks import label_vectors
from vecshoal.operators import partials
from vecshoal.operators.partials import Blocks, batches_of, dealt_evenly, gathered, working_copy
from vecshoal.session import remove_path, scratch_path, small_table

_CELLS = 1 << 21
_BLOCK = 2048
_MIX = np.uint64(0xD6E8FEB86659FD93)
# Passes before the first marks: at first most rows change their centre.
UNMARKED = 2


@dataclass
class Fit:
    """One K-Means fit: centres of one group for one k and one restart."""

    group: int
    k: int
    restart: int
    centers: np.ndarray
    tolerance: float = 0.0
    sse: float = float("nan")
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    iterations: int = 0
    converged: bool = False
    # Distances computed between rows and centres.
    distances: int = 0


class _Told(AccumulatorParam):
    """Few numbers of each fit, told to the driver by the task that moved its centres."""

    def zero(self, value: list) -> list:
        return []

    def addInPlace(self, value1: list, value2: list) -> list:
        return value1 + value2


@dataclass
class GroupFacts:
    """Row count, mean and mean variance of one group."""

    rows: int
    mean: np.ndarray
    variance: float


def closest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of every row of a matrix; the lowest number on ties."""
    half = 0.5 * (centers**2).sum(axis=1)
    step = max(1, _CELLS // len(centers))
    parts = [(half - rows[i : i + step] @ centers.T).argmin(axis=1) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def closest_few(rows: np.ndarray, centers: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` nearest centres of every row, nearest first; all centres where there are fewer."""
    half, count = 0.5 * (centers**2).sum(axis=1), min(count, len(centers))
    step = max(1, _CELLS // len(centers))
    parts = [np.argsort(half - rows[i : i + step] @ centers.T, axis=1, kind="stable")[:, :count] for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros((0, count), dtype=np.int64)


def nearest(vector: Column | str, centers: np.ndarray) -> Column:
    """Number of the nearest centre; NULL for a vector that does not fit."""
    width = centers.shape[1]

    @F.arrow_udf("int")
    def label(column: pa.Array) -> pa.Array:
        return label_vectors(column, width, lambda rows: closest(rows, centers))

    return label(vector)


def grouped(points: DataFrame, vector: str, group: str | None) -> DataFrame:
    """``(g, v)``: the group number and the vector of every row that has both."""
    label = F.col(group).cast("int") if group else F.lit(0)
    return points.select(label.alias("g"), F.col(vector).alias("v")).where("g IS NOT NULL AND v IS NOT NULL")


def group_facts(blocks: Blocks) -> dict[int, GroupFacts]:
    """Facts about every group, from one pass."""

    def merge(a, b):
        for g, (n, mean, square) in b.items():
            if g in a:
                m, own, sum_of = a[g]
                away = mean - own
                a[g] = m + n, own + away * (n / (m + n)), sum_of + square + away**2 * (m * n / (m + n))
            else:
                a[g] = n, mean, square
        return a

    def fold(held):
        state = {}
        for groups, x in held:
            for g in np.unique(groups):
                own = x[groups == g]
                mean = own.mean(axis=0)
                state = merge(state, {int(g): (len(own), mean, ((own - mean) ** 2).sum(axis=0))})
        return state

    found = blocks.reduce(fold, merge)
    return {g: GroupFacts(n, mean, float(np.mean(square)) / n) for g, (n, mean, square) in sorted(found.items())}


def value_hash(x: np.ndarray) -> np.ndarray:
    """64 bits of each row of a matrix; equal rows have equal hashes, in whatever order and block they come."""
    odd = np.random.default_rng(9).integers(1, 1 << 63, x.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = (np.ascontiguousarray(x + 0.0).view(np.uint64) * odd).sum(axis=1, dtype=np.uint64)
    h ^= h >> np.uint64(32)
    return h * _MIX


def _least(hashes: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` rows of least hash, each value once."""
    if len(hashes) > 4 * count:
        near = np.partition(hashes, 4 * count)[4 * count]
        if len(np.unique(hashes[hashes <= near])) >= count:
            rows, hashes = rows[hashes <= near], hashes[hashes <= near]
    hashes, at = np.unique(hashes, return_index=True)
    return hashes[:count], rows[at[:count]]


def draw_starts(blocks: Blocks, most: int, restarts: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """``most`` rows of different value, or all there are, by group and restart, drawn from all rows.

    A hash of the value decides, so the draw does not depend on how rows are laid out, nor on how often a value comes.
    """
    salts = np.random.default_rng(seed).integers(1, 1 << 63, restarts, dtype=np.uint64)

    def merge(a, b):
        for key, (hashes, rows) in b.items():
            if key in a:
                a[key] = _least(np.concatenate([a[key][0], hashes]), np.concatenate([a[key][1], rows]), most)
            else:
                a[key] = hashes, rows
        return a

    def fold_for(numbers):
        def fold(held):
            state = {}
            for groups, x in held:
                h = value_hash(x)
                for g in np.unique(groups):
                    own, rows = h[groups == g], x[groups == g]
                    for r in numbers:
                        u = (own ^ salts[r]) * _MIX
                        state = merge(state, {(int(g), int(r)): _least(u ^ (u >> np.uint64(32)), rows, most)})
            return state

        return fold

    size = most * blocks.width * 8
    drawn = {}
    for numbers in batches_of(list(range(restarts)), lambda r: size, partials.STATE_BYTES):
        drawn |= blocks.reduce(fold_for(numbers), merge, size * len(numbers))
    return {key: rows for key, (_, rows) in drawn.items()}


def _gaps(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distance of every row to its nearest centre; what is only rounding noise counts as 0."""
    square = (rows**2).sum(axis=1)
    gap = square + 2 * (0.5 * (centers**2).sum(axis=1) - rows @ centers.T).min(axis=1)
    gap[gap <= 1e-12 * np.maximum(square, 1e-300)] = 0.0
    return gap


def spread_starts(blocks: Blocks, sizes: list[int], seed: int = 0, rounds: int = 4, factor: int = 2) -> dict[int, np.ndarray]:
    """Starts for each size, spread over all rows: rounds of drawing by squared distance, and a weighted reduction of what was drawn.

    A round is one pass. It draws ``factor`` times the largest size of rows of different value, each with a chance in proportion to its squared distance to
    what was drawn before: a row waits for a time of that rate, told by a hash of its value, and the first ones are taken, whatever the
    layout. Another pass counts the rows nearest to each. From these few weighted rows the starts of all sizes are drawn by squared
    distance, and moved to the means of what is nearest.
    """
    most = max(sizes)
    salts = np.random.default_rng(seed).integers(1, 1 << 63, rounds + 1, dtype=np.uint64)

    def drawn(salt: np.uint64, count: int, known: np.ndarray | None) -> np.ndarray:
        def first(waits, hashes, rows):
            order = np.lexsort((hashes, waits))
            _, at = np.unique(hashes[order], return_index=True)
            order = order[np.sort(at)][:count]
            return waits[order], hashes[order], rows[order]

        def fold(held):
            state = None
            for _, x in held:
                h = (value_hash(x) ^ salt) * _MIX
                rate = np.ones(len(x)) if known is None else _gaps(x, known)
                live = np.flatnonzero(rate > 0)
                waits = -np.log(((h[live] >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[live]
                found = first(waits, h[live], x[live])
                state = found if state is None else first(*map(np.concatenate, zip(state, found)))
            return state

        def merge(a, b):
            return a if b is None else b if a is None else first(*map(np.concatenate, zip(a, b)))

        found = blocks.reduce(fold, merge, count * blocks.width * 8)
        return found[2] if found is not None else np.zeros((0, blocks.width))

    chosen = drawn(salts[0], 1, None)
    for salt in salts[1:]:
        chosen = np.concatenate([chosen, drawn(salt, factor * most, chosen)])

    def count(held, state):
        for _, x in held:
            state[:, 0] += np.bincount(closest(x, chosen), minlength=len(chosen))

    weights = blocks.total(count, len(chosen), 1)[:, 0]
    rng = np.random.default_rng(seed)
    order = [int(rng.choice(len(chosen), p=weights / weights.sum()))]
    while len(order) < min(most, len(chosen)):
        away = _gaps(chosen, chosen[order]) * weights
        if not away.any():
            break
        order.append(int(rng.choice(len(chosen), p=away / away.sum())))
    starts = {}
    for k in sizes:
        centers = chosen[order[:k]].copy()
        for _ in range(20):
            near = closest(chosen, centers)
            held = np.bincount(near, weights=weights, minlength=len(centers))
            sums = np.zeros_like(centers)
            np.add.at(sums, near, chosen * weights[:, None])
            centers[held > 0] = sums[held > 0] / held[held > 0, None]
        starts[k] = np.resize(centers, (k, blocks.width))
    return starts


def _single(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(x, 1)`` in single precision, and the lengths of ``x``."""
    with np.errstate(over="ignore"):
        return np.hstack([x, np.ones((len(x), 1))]).astype(np.float32), np.sqrt((x**2).sum(axis=1))


class _Centers:
    """The centres of a fit, to be compared with rows.

    Scores are half the squared distances, short of ``x x / 2``. They are taken in single precision; rows that have more than one score within
    twice the bound of its rounding, or numbers that single precision does not hold, are compared in double precision.
    """

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        self.scorer = np.vstack([-centers.T, 0.5 * (centers**2).sum(axis=1)])
        with np.errstate(over="ignore"):
            self.single = np.ascontiguousarray(self.scorer.T, dtype=np.float32)
        self.longest = float(np.sqrt((centers**2).sum(axis=1).max()))
        self.numbers = np.vstack([np.ones(len(centers)), np.arange(len(centers))]).astype(np.float32)

    def scores(self, rows: np.ndarray, single: np.ndarray, lengths: np.ndarray, some: np.ndarray | slice) -> tuple[np.ndarray, ...]:
        """Nearest centre of ``some`` rows, single scores of all centres (a row each), and twice their rounding."""
        single, lengths = single[some], lengths[some]
        with np.errstate(over="ignore", invalid="ignore"):
            size = lengths * self.longest + 0.5 * self.longest**2
            slack = np.where(size < 1e37, (single.shape[1] + 16) * 2.0**-23 * size + 1e-30, np.inf).astype(np.float32)
            away = self.single @ single.T
            count, chosen = self.numbers @ (away <= away.min(axis=0) + slack).astype(np.float32)
        chosen = chosen.astype(np.int64)
        unsure = np.flatnonzero(count != 1)
        if len(unsure):
            exact = rows[some][unsure] if isinstance(some, slice) else rows[some[unsure]]
            chosen[unsure] = (exact @ self.scorer[:-1] + self.scorer[-1]).argmin(axis=1)
        return chosen, away, slack

    def nearest(self, rows: np.ndarray, single: np.ndarray, lengths: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
        """Nearest centre of every row, or of ``some``, taken in blocks, so that scores stay in cache."""
        chosen = np.zeros(len(rows if some is None else some), dtype=np.int64)
        if len(self.centers) > 1:
            for at in _blocks(chosen):
                chosen[at] = self.scores(rows, single, lengths, at if some is None else some[at])[0]
        return chosen


def _blocks(x: np.ndarray) -> list[slice]:
    return [slice(at, at + _BLOCK) for at in range(0, len(x), _BLOCK)]


def _tally(x: np.ndarray, fits: list[tuple[_Centers, bool]], state: np.ndarray) -> None:
    """Add to ``state`` the row count of every centre of every fit, and the squared distance for a fit that made its last move, or the vector sum."""
    single, lengths = _single(x)
    columns = np.ascontiguousarray(x.T)
    lo = 0
    for fit, last in fits:
        hi = lo + len(fit.centers)
        chosen = fit.nearest(x, single, lengths)
        if last:
            _add_missed(state[lo:hi], chosen, x, fit.centers)
        else:
            _add_columns(state[lo:hi], chosen, columns)
        lo = hi


def _add_missed(state: np.ndarray, chosen: np.ndarray, rows: np.ndarray, centers: np.ndarray) -> None:
    """Add to ``state`` the row count and the squared distance of every chosen centre."""
    away = ((rows - centers[chosen]) ** 2).sum(axis=1)
    state[:, 0] += np.bincount(chosen, minlength=len(state))
    state[:, 1] += np.bincount(chosen, weights=away, minlength=len(state))


def _add_columns(state: np.ndarray, chosen: np.ndarray, columns: np.ndarray) -> None:
    """Add to ``state`` the row count and the vector sum of every chosen centre, for many rows, given by their columns."""
    state[:, 0] += np.bincount(chosen, minlength=len(state))
    state[:, 2:] += np.array([np.bincount(chosen, weights=column, minlength=len(state)) for column in columns]).T


def _add_sums(state: np.ndarray, chosen: np.ndarray, rows: np.ndarray, sign: int = 1) -> None:
    """Add to ``state`` the row count and the vector sum of every chosen centre, for few rows."""
    k = len(state)
    counts = np.bincount(chosen, minlength=k)
    held = np.flatnonzero(counts)
    if len(held):
        # Sorting small integers takes linear time.
        order = np.argsort(chosen.astype(np.uint16 if k <= 1 << 16 else np.int64), kind="stable")
        state[:, 0] += sign * counts
        state[held, 2:] += sign * np.add.reduceat(rows[order], np.cumsum(counts[held]) - counts[held], axis=0)


def _two_nearest(x: np.ndarray, fits: list[_Centers]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every fit the nearest centre of every row, and a lower bound of how much farther the second nearest is."""
    sizes = [len(fit.centers) for fit in fits]
    marks = [(np.zeros(len(x), dtype=np.uint8 if k <= 1 << 8 else np.uint16 if k <= 1 << 16 else np.int32), np.full(len(x), np.inf, dtype=np.float32)) for k in sizes]
    single, lengths = _single(x)
    for fit, (labels, gaps) in zip(fits, marks):
        for at in _blocks(x) if len(fit.centers) > 1 else ():
            chosen, away, slack = fit.scores(x, single, lengths, at)
            line, square = np.arange(len(chosen)), lengths[at] ** 2
            first = 2.0 * away[chosen, line] + square
            away[chosen, line] = np.inf
            second = 2.0 * away.min(axis=0) + square
            # Squares come from differences of larger numbers, whose rounding may not make a bound too good.
            noise = 2.0 * slack.astype(np.float64) + 1e-12 * square
            with np.errstate(invalid="ignore"):
                gap = np.sqrt(np.clip(second - noise, 0.0, None)) - np.sqrt(np.clip(first + noise, 0.0, None))
            labels[at] = chosen
            # What single precision does not hold has no gap.
            gaps[at] = np.where(np.isfinite(noise), np.nextafter(gap.astype(np.float32), np.float32(-np.inf)), -np.inf)
    return marks


class _Run:
    """The passes of some fits over the rows, all fits together until each has converged.

    Centres stay with the executors: a pass takes them from the shared folder, tallies are added up by tasks, and the moved centres are stored for the next
    pass. The driver gets a few numbers of each fit, and the centres of those that are done.

    Marks spare distances: for every row and open fit the nearest centre at one time, and how much farther the second one was.
    Centres have since moved by known distances. A row's centre is the same as long as its gap is larger than the move of its own centre
    and the largest move of another together. Marks stay as they are, beside the rows on the executors (five bytes a row and fit
    of at most 256 centres), so that a lost executor makes its own again from the rows and the centres of that time. Tallies are those of
    that time, and passes add the rows that changed. Once the passes have computed as many distances as new marks need, new ones are made, which is a pass and a move as well.
    """

    def __init__(self, blocks: Blocks, fits: list[Fit], max_iter: int, refill: bool):
        self.blocks, self.fits, self.max_iter, self.refill = blocks, fits, max_iter, refill
        self.spark = SparkSession.active()
        self.folders: dict[str, str] = {}
        # One for all passes, emptied after each: PySpark keeps every accumulator it was asked for.
        self.told = self.spark.sparkContext.accumulator([], _Told())
        # Numbers of the fits not done, and whether they have made their last move; the pass after that only measures.
        self.last = {n: fit.converged or fit.iterations >= max_iter for n, fit in enumerate(fits)}
        held = [{"n": n, "centers": fit.centers, "iterations": fit.iterations, "last": self.last[n], "tolerance": fit.tolerance} for n, fit in enumerate(fits)]
        self.model = self._store("centers", self.spark.sparkContext.parallelize([held], 1))
        self.marks: Blocks | None = None
        # Centres and tallies of the time of the marks.
        self.known: list[RDD] = []
        self.price: dict[int, int] = {}
        self.spent = 0

    def _store(self, label: str, rdd: RDD) -> RDD:
        """The only element of ``rdd`` in the shared folder, instead of what was there under this label."""
        path = scratch_path(self.spark, label)
        rdd.saveAsPickleFile(path, 1)
        before = self.folders.get(label)
        if before is not None and before != self.folders.get("marked"):
            remove_path(self.spark, before)
        self.folders[label] = path
        return self.spark.sparkContext.pickleFile(path, 1).coalesce(1)

    def _layout(self) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Number and group of the open fits, and where the rows of each begin in a state."""
        return [(n, self.fits[n].group) for n in self.last], np.cumsum([0, *(self.fits[n].k for n in self.last)])

    def mark(self) -> None:
        """New marks from the centres as they are, and a move of all open fits but those that made their last."""
        self._unmark()
        layout, ends = self._layout()
        max_iter, refill = self.max_iter, self.refill
        self.folders["marked"] = self.folders["centers"]
        shape, told = (int(ends[-1]), self.blocks.width + 2), self.told

        def attach(model, held):
            by_group = {}
            for fit, (_, group) in zip(model, layout):
                by_group.setdefault(group, []).append((fit["n"], _Centers(fit["centers"])))
            for own, x in held:
                found = {}
                for g in np.unique(own):
                    mine = by_group.get(int(g), [])
                    found |= dict(zip([n for n, _ in mine], _two_nearest(x[own == g], [fit for _, fit in mine])))
                yield own, x, found

        def sums(held):
            state = np.zeros(shape)
            for own, x, marks in held:
                for g in np.unique(own):
                    columns = np.ascontiguousarray(x[own == g].T)
                    for (n, group), lo, hi in zip(layout, ends, ends[1:]):
                        if group == g:
                            _add_columns(state[lo:hi], marks[n][0], columns)
            yield _used(state)

        def known(elements):
            state, model, _ = _added(elements, shape)
            if model is None:
                return [_used(state)]
            tallies = np.split(state, ends[1:-1])
            told.add([(fit["n"], int(tally[:, 0].sum())) for fit, tally in zip(model, tallies)])
            return [{fit["n"]: (fit["centers"], tally) for fit, tally in zip(model, tallies)}]

        marked = self.model
        self.marks = Blocks(self.blocks.with_model(marked, attach).persist(StorageLevel.MEMORY_AND_DISK), self.blocks.width)
        with gathered(self.marks.kept.mapPartitions(sums), known, [marked]) as found:
            self.known = [self._store("known", found)]
        self.price = {n: rows * self.fits[n].k for n, rows in self._said()}
        for n, price in self.price.items():
            self.fits[n].distances += price
        self.spent = 0

        def moved(elements):
            _, model, known = _added(elements, (0, 0))
            still, said = [], []
            for fit in model:
                fit, lost = fit | {"reach": np.zeros(len(fit["centers"]))}, 0
                if not fit["last"]:
                    fit, lost = _stepped(fit, known[fit["n"]][1], max_iter, refill, known)
                still.append(fit)
                said.append((fit["n"], 0, lost, fit["last"]))
            told.add(said)
            return [still]

        self.model = self._store("centers", self.spark.sparkContext.union([marked, *self.known]).coalesce(1).mapPartitions(moved))
        self._heard(self._said())

    def _unmark(self) -> None:
        if self.marks is not None:
            self.marks.kept.unpersist()
            if self.folders["marked"] != self.folders["centers"]:
                remove_path(self.spark, self.folders["marked"])
            del self.folders["marked"]
            self.marks, self.known = None, []

    def _worn(self) -> bool:
        """Whether the passes since have computed as many distances as marks for the open fits would."""
        return self.spent >= sum(self.price[n] for n in self.last)

    def one_pass(self) -> None:
        """One pass and one move of all open fits."""
        layout, ends = self._layout()
        shape, told = (int(ends[-1]) + len(layout), self.blocks.width + 2), self.told
        max_iter, refill, by_marks = self.max_iter, self.refill, self.marks is not None

        def fold(model, held):
            state = np.zeros(shape)
            (_by_marks if by_marks else _by_distances)(model, layout, ends, held, state)
            yield _used(state)

        def moved(elements):
            state, model, known = _added(elements, shape)
            if model is None:
                return [_used(state)]
            still, said = [], []
            for fit, lo, hi, spent in zip(model, ends, ends[1:], state[ends[-1] :, 0]):
                n, tally, centers = fit["n"], state[lo:hi], fit["centers"]
                if not by_marks:
                    spent = tally[:, 0].sum() * len(centers)
                if fit["last"]:
                    said.append((n, int(spent), 0, (centers, tally[:, 0].copy(), float(tally[:, 1].sum()), fit["iterations"])))
                    continue
                moved, lost = _stepped(fit, tally + known[n][1] if by_marks else tally, max_iter, refill, known)
                still.append(moved)
                said.append((n, int(spent), lost, moved["last"]))
            told.add(said)
            return [still]

        with gathered((self.marks or self.blocks).with_model(self.model, fold), moved, [self.model, *self.known]) as found:
            self.model = self._store("centers", found)
        self._heard(self._said())

    def _said(self) -> list[tuple]:
        """What tasks have told since the last time."""
        said, self.told.value = self.told.value, []
        return said

    def _heard(self, said: list[tuple]) -> None:
        """Take in what a move has told of each fit: its distances, how many centres lost their rows, and whether the next pass is its last, or its end."""
        bare = {}
        for n, spent, lost, end in said:
            fit = self.fits[n]
            fit.distances += spent
            self.spent += spent
            if isinstance(end, tuple):
                fit.centers, fit.sizes, fit.sse, fit.iterations = end
                fit.converged = True
                del self.last[n]
            else:
                self.last[n] = end
                if lost:
                    bare[n] = lost
        if bare:
            self._refilled(bare)

    def _refilled(self, bare: dict[int, int]) -> None:
        """Move centres that lost all their rows to the rows farthest from any centre; without any such row they stay."""
        group, max_iter, told = {n: self.fits[n].group for n in bare}, self.max_iter, self.told

        def best(away, hashes, rows, count):
            order = np.lexsort((hashes, -away))
            _, first = np.unique(hashes[order], return_index=True)
            order = order[np.sort(first)][:count]
            return away[order], hashes[order], rows[order]

        def merge(a, b):
            return a | {n: best(*map(np.concatenate, zip(a[n], found)), bare[n]) if n in a else found for n, found in b.items()}

        def farthest(model, held):
            live = {fit["n"]: np.delete(fit["centers"], fit["lost"], axis=0) for fit in model if fit["n"] in bare}
            state = {}
            for groups, x in held:
                for n, centers in live.items():
                    rows = x[groups == group[n]]
                    if len(rows):
                        gap = _gaps(rows, centers)
                        near = np.flatnonzero(gap > 0)
                        state = merge(state, {n: best(gap[near], value_hash(rows[near]), rows[near], bare[n])})
            yield ("far", state)

        def filled(elements):
            far, model, known = {}, None, None
            for element in elements:
                if isinstance(element, tuple):
                    far = merge(far, element[1])
                elif isinstance(element, list):
                    model = element
                else:
                    known = element
            if model is None:
                return [("far", far)]
            still, said = [], []
            for fit in model:
                if fit["n"] in bare:
                    before, lost = fit["before"], fit["lost"]
                    fit = {name: value for name, value in fit.items() if name not in ("before", "lost")}
                    if fit["n"] in far:
                        rows = far[fit["n"]][2]
                        fit["centers"][lost[: len(rows)]] = rows
                    fit = _judged(fit, before, max_iter, known)
                    said.append((fit["n"], fit["last"]))
                still.append(fit)
            told.add(said)
            return [still]

        with gathered(self.blocks.with_model(self.model, farthest), filled, [self.model, *self.known]) as found:
            self.model = self._store("centers", found)
        self.last |= dict(self._said())

    def go(self, unmarked: float) -> None:
        passes = 0
        try:
            while self.last:
                if passes >= unmarked and (self.marks is None or self._worn()) and not all(self.last.values()):
                    self.mark()
                else:
                    self.one_pass()
                passes += 1
        finally:
            self._unmark()
            for path in self.folders.values():
                remove_path(self.spark, path)


def _used(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A state without its empty rows: their numbers, and the rows."""
    used = np.flatnonzero(state.any(axis=1))
    return used, state[used]


def _added(elements, shape: tuple[int, int]) -> tuple:
    """The sum of all states among ``elements``, the list of open fits, and what is known of the time of the marks."""
    state, model, known = np.zeros(shape), None, None
    for element in elements:
        if isinstance(element, tuple):
            state[element[0]] += element[1]
        elif isinstance(element, list):
            model = element
        else:
            known = element
    return state, model, known


def _stepped(fit: dict, tally: np.ndarray, max_iter: int, refill: bool, known: dict | None) -> tuple[dict, int]:
    """A fit whose centres moved to the means of ``tally``, and how many lost all their rows; with any of these it waits for its refill."""
    full, before = tally[:, 0] > 0, fit["centers"]
    fit = fit | {"centers": before.copy(), "iterations": fit["iterations"] + 1}
    fit["centers"][full] = tally[full, 2:] / tally[full, :1]
    lost = np.flatnonzero(~full) if refill else ()
    return (fit | {"before": before, "lost": lost} if len(lost) else _judged(fit, before, max_iter, known)), len(lost)


def _judged(fit: dict, before: np.ndarray, max_iter: int, known: dict | None) -> dict:
    """A fit that moved from ``before``, with whether that was its last move, and how far marks reach that lie as far behind as ``known``."""
    still = float(((fit["centers"] - before) ** 2).sum()) <= fit["tolerance"]
    fit = fit | {"last": still or fit["iterations"] >= max_iter}
    if known is not None:
        moves = np.sqrt(((fit["centers"] - known[fit["n"]][0]) ** 2).sum(axis=1))
        order = np.argsort(moves)[::-1]
        others = np.full(len(moves), moves[order[0]])
        others[order[0]] = moves[order[1]] if len(moves) > 1 else 0.0
        # Sums of differences are rounded too.
        fit["reach"] = (moves + others) * (1 + 1e-12)
    return fit


def _by_distances(fits: list[dict], layout: list[tuple[int, int]], ends: np.ndarray, held, state: np.ndarray) -> None:
    """Add to ``state`` the tallies of all centres of all fits, which come in order of their groups."""
    models = {}
    for fit, (_, g), lo, hi in zip(fits, layout, ends, ends[1:]):
        first, _, some = models.get(g, (lo, hi, []))
        models[g] = first, hi, [*some, (_Centers(fit["centers"]), fit["last"])]
    for groups, x in held:
        for g in np.unique(groups):
            if int(g) in models:
                lo, hi, some = models[int(g)]
                _tally(x[groups == g], some, state[lo:hi])


def _by_marks(fits: list[dict], layout: list[tuple[int, int]], ends: np.ndarray, held, state: np.ndarray) -> None:
    """Add to ``state`` squared distances for fits that made their last move, and for others the vector sums of the rows that changed since the
    marks; behind them the number of distances computed for each fit."""
    models = {}
    for n, (fit, (_, g)) in enumerate(zip(fits, layout)):
        models.setdefault(g, []).append((n, fit["n"], fit["last"], _Centers(fit["centers"]), fit["reach"]))
    for own, x, marks in held:
        for g in np.unique(own):
            rows = x[own == g]
            single, lengths = _single(rows)
            for n, place, last, fit, reach in models.get(int(g), ()):
                labels, gaps = marks[place]
                open_rows = np.flatnonzero(gaps <= reach[labels])
                # Where nearly all rows are open, comparing all takes less time than picking them.
                some = open_rows if len(open_rows) < 0.8 * len(rows) else None
                chosen = fit.nearest(rows, single, lengths, some)
                spent, tally = state[ends[-1] + n], state[ends[n] : ends[n + 1]]
                spent[0] += len(chosen) * len(fit.centers)
                if last:
                    now = labels.astype(np.int64)
                    now[slice(None) if some is None else some] = chosen
                    spent[0] += len(rows)
                    _add_missed(tally, now, rows, fit.centers)
                    continue
                before = labels if some is None else labels[some]
                changed = np.flatnonzero(chosen != before)
                moved = rows[changed if some is None else some[changed]]
                _add_sums(tally, chosen[changed], moved)
                _add_sums(tally, before[changed], moved, -1)


def run_lloyd(blocks: Blocks, fits: list[Fit], max_iter: int, refill: bool = True, unmarked: float = UNMARKED) -> list[Fit]:
    """Iterate all fits together, one pass over the rows at a time, until each has converged.

    After ``unmarked`` passes marks spare the rows whose centre cannot have changed; centres are the same with and without them.
    Fits whose states are too large together take turns.
    """
    ordered = sorted(fits, key=lambda fit: fit.group)
    for some in batches_of(ordered, lambda fit: fit.k * (blocks.width + 2) * 8, partials.STATE_BYTES):
        _Run(blocks, some, max_iter, refill).go(unmarked)
    return ordered


def fit_blocks(
    blocks: Blocks,
    grid: list[int] | dict[int, list[int]],
    restarts: int = 10,
    max_iter: int = 300,
    tol: float = 1e-4,
    seed: int = 42,
) -> list[Fit]:
    """As :func:`fit_many`, over a working copy."""
    facts = group_facts(blocks)
    sizes = {g: [k for k in (grid.get(g, []) if isinstance(grid, dict) else grid) if k <= fact.rows] for g, fact in facts.items()}
    most = max((k for ks in sizes.values() for k in ks), default=0)
    starts = draw_starts(blocks, most, restarts, seed) if most > 1 else {}
    fits = []
    for g, fact in facts.items():
        for k in sizes[g]:
            # With k = 1 every start leads to the mean.
            for restart in range(restarts if k > 1 else 1):
                rows = fact.mean[None, :] if k == 1 else starts[g, restart]
                fits.append(Fit(g, k, restart, np.resize(rows[:k], (k, blocks.width)), tol * fact.variance))
    return run_lloyd(blocks, fits, max_iter) if fits else []


def fit_many(
    points: DataFrame,
    grid: list[int] | dict[int, list[int]],
    vector: str = "reduced",
    group: str | None = None,
    restarts: int = 10,
    max_iter: int = 300,
    tol: float = 1e-4,
    seed: int = 42,
    width: int | None = None,
) -> list[Fit]:
    """Fit K-Means for every k of ``grid`` and every restart, in every group.

    ``grid`` is one list of k for all groups, or one list per group. A k above the row count of
    its group has no fit. Vectors that have not ``width`` finite elements (default: the most common number) are left out.
    ``points`` is read once, into a copy that the executors keep.
    """
    with working_copy(dealt_evenly(grouped(points, vector, group)), width) as blocks:
        return fit_blocks(blocks, grid, restarts, max_iter, tol, seed)


def fit_from(points: DataFrame, start: np.ndarray, vector: str = "reduced", max_iter: int = 300, tol: float = 0.0) -> Fit:
    """Lloyd iterations from given centres; a centre that loses its rows stays where it is."""
    fit = Fit(0, len(start), 0, np.array(start, dtype=np.float64), tol)
    with working_copy(grouped(points, vector, None), start.shape[1]) as blocks:
        return run_lloyd(blocks, [fit], max_iter, refill=False)[0]


def fit_given(
    points: DataFrame,
    starts: dict[tuple[int, int], np.ndarray],
    vector: str = "reduced",
    group: str | None = None,
    max_iter: int = 300,
    tol: float = 0.0,
) -> list[Fit]:
    """One fit for every group and k of ``starts``, from the centres given there, all in the same passes.

    A centre that loses its rows stays where it is.
    """
    fits = [Fit(g, k, 0, np.array(start, dtype=np.float64), tol) for (g, k), start in sorted(starts.items())]
    with working_copy(grouped(points, vector, group), fits[0].centers.shape[1]) as blocks:
        return run_lloyd(blocks, fits, max_iter, refill=False)


def best_fits(fits: list[Fit]) -> dict[tuple[int, int], Fit]:
    """The restart with the least sum of squares for every group and k."""
    best: dict[tuple[int, int], Fit] = {}
    for fit in fits:
        known = best.get((fit.group, fit.k))
        if known is None or fit.sse < known.sse:
            best[fit.group, fit.k] = fit
    return best


def sweep_table(spark: SparkSession, best: dict[tuple[int, int], Fit], group: str = "curve") -> DataFrame:
    """``(group, k, sse)`` of the best fits."""
    rows = [(g, k, fit.sse) for (g, k), fit in sorted(best.items())]
    return small_table(spark, rows, f"{group} int, k int, sse double")


def centroid_table(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    rows = [(i, center.tolist()) for i, center in enumerate(centers)]
    return small_table(spark, rows, "cluster_id int, centroid array<double>")
