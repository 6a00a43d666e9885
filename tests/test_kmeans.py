import pickle

import numpy as np
import pytest
from pyspark import RDD, accumulators
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from vecshoal.operators import kmeans, partials
from vecshoal.operators.partials import working_copy
from vecshoal.operators.secondary import fit_secondary


def blobs(seed=1, rows=240, width=4, centres=5, spread=0.4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(scale=4, size=(centres, width))
    return middle[rng.integers(centres, size=rows)] + spread * rng.normal(size=(rows, width))


def plain_lloyd(x, centers, rounds):
    for _ in range(rounds):
        label = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centers)])
    return centers, ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.fixture(params=[0, 64 << 20], ids=["a pass per fit", "one pass for all"])
def split(request, monkeypatch):
    monkeypatch.setattr(partials, "STATE_BYTES", request.param)


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_same_as_plain_lloyd(points, rounds):
    x = blobs()
    fit = kmeans.fit_from(points(x), x[:7].copy(), max_iter=rounds)
    centers, sse = plain_lloyd(x, x[:7], rounds)
    np.testing.assert_allclose(fit.centers, centers)
    assert fit.sse == pytest.approx(sse)
    assert fit.sizes.sum() == len(x)


def test_sweep(points, split):
    x = blobs()
    fits = kmeans.fit_many(points(x), [1, 2, 5, 9, 300], restarts=4)
    best = kmeans.best_fits(fits)
    assert sorted(k for _, k in best) == [1, 2, 5, 9]
    assert best[0, 1].sse == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    for fit in fits:
        assert best[0, fit.k].sse <= fit.sse
        assert fit.sizes.sum() == len(x) and (fit.sizes > 0).all()
        label = ((x[:, None] - fit.centers[None]) ** 2).sum(axis=2)
        assert fit.sse == pytest.approx(label.min(axis=1).sum())
    order = [best[0, k].sse for k in (1, 2, 5, 9)]
    assert order == sorted(order, reverse=True)


def test_finds_the_blobs_like_spark_does(spark, points):
    x = blobs()
    ours = kmeans.best_fits(kmeans.fit_many(points(x), [5]))[0, 5].sse
    rows = points(x).select(array_to_vector("reduced").alias("features"))
    theirs = min(KMeans(k=5, seed=s, initMode="random").fit(rows).summary.trainingCost for s in range(5))
    assert ours <= theirs * 1.0001


def test_layout_does_not_matter(points):
    x = blobs()
    one = kmeans.fit_many(points(x, 1), [4], restarts=2)
    many = kmeans.fit_many(points(x, 7), [4], restarts=2)
    for a, b in zip(one, many):
        np.testing.assert_allclose(a.centers, b.centers)


def test_fits_together_or_in_batches(points, monkeypatch):
    x = np.vstack([blobs(1, 150), blobs(2, 90) + 20])
    table = points(x, g=[0] * 150 + [4] * 90)
    together = kmeans.fit_many(table, [1, 3, 6], group="g", restarts=3)
    monkeypatch.setattr(partials, "STATE_BYTES", 500)
    batched = kmeans.fit_many(table, [1, 3, 6], group="g", restarts=3)
    assert len(together) == len(batched) == 14
    for a, b in zip(together, batched):
        assert (a.group, a.k, a.restart, a.iterations) == (b.group, b.k, b.restart, b.iterations)
        np.testing.assert_allclose(a.centers, b.centers)
        assert list(a.sizes) == list(b.sizes)
        assert a.sse == pytest.approx(b.sse)


def test_groups_are_fitted_apart(points, split):
    x, y = blobs(1, 90), blobs(2, 60) + 50
    label = [3] * 90 + [8] * 60
    fits = kmeans.fit_many(points(np.vstack([x, y]), g=label), {3: [1, 3], 8: [1, 2]}, group="g", restarts=3)
    best = kmeans.best_fits(fits)
    assert sorted(best) == [(3, 1), (3, 3), (8, 1), (8, 2)]
    assert best[3, 1].sse == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert best[8, 1].sse == pytest.approx(((y - y.mean(axis=0)) ** 2).sum())
    assert best[3, 3].sizes.sum() == 90 and best[8, 2].sizes.sum() == 60


def test_copies_leave_no_cluster_empty(points, split):
    x = blobs(rows=200)
    x[:70] = x[0]
    for fit in kmeans.fit_many(points(x), [20], restarts=5):
        assert (fit.sizes > 0).all()


def test_fewer_values_than_clusters(points, split):
    x = np.repeat(np.array([[0.0, 0.0], [1.0, 1.0]]), 10, axis=0)
    best = kmeans.best_fits(kmeans.fit_many(points(x), [1, 2, 4], restarts=2))
    assert best[0, 2].sse == pytest.approx(0.0)
    assert best[0, 4].sse == pytest.approx(0.0)


def test_a_lost_centre_is_moved(points):
    x = np.vstack([blobs(rows=50, centres=1), [[30.0, 30.0, 30.0, 30.0]]])
    fits = [kmeans.Fit(0, 2, 0, np.array([x[0], np.full(4, -1000.0)]), 0.0)]
    with partials.working_copy(kmeans.grouped(points(x), "reduced", None)) as blocks:
        fit = kmeans.run_lloyd(blocks, fits, 50)[0]
    assert sorted(fit.sizes) == [1, 50]


def test_few_values_fill_all_clusters(points):
    """Forty thousand rows of 31 values: twenty clusters are filled, whatever the values' shares."""
    rng = np.random.default_rng(3)
    values = rng.normal(size=(31, 3)) * 10
    x = values[np.minimum(rng.geometric(0.2, 40_000) - 1, 30)]
    x[:31] = values
    fits = kmeans.fit_many(points(x), [20], restarts=4)
    assert all((fit.sizes > 0).all() for fit in fits)


def test_many_groups(points):
    x = blobs(rows=1500)
    fits = kmeans.fit_many(points(x, g=[n % 500 for n in range(1500)]), [1, 2], group="g", restarts=1)
    assert len(fits) == 1000 and all(fit.sizes.sum() == 3 for fit in fits)


def test_short_vectors_and_missing_ids_are_no_obstacle(spark, points):
    x = blobs()
    odd = spark.createDataFrame([("a", [1.0]), ("b", None), (None, [float("nan")] * 4), ("c", [float("inf"), 0.0, 0.0, 0.0])], "id string, reduced array<double>")
    nameless = points(x).selectExpr("cast(null as string) as id", "reduced")
    fits = kmeans.fit_many(odd.unionByName(nameless), [3], restarts=2)
    same = kmeans.fit_many(points(x), [3], restarts=2)
    for a, b in zip(fits, same):
        assert a.sizes.sum() == len(x)
        np.testing.assert_allclose(a.centers, b.centers)
    assert kmeans.fit_many(odd.where("id = 'b'"), [1]) == []


def test_nearest_takes_the_lowest_number_and_skips_misfits(spark):
    rows = spark.createDataFrame(
        [("tie", [0.0]), ("b", [0.9]), ("wide", [1.0, 2.0]), ("none", None)], "id string, v array<double>"
    )
    label = kmeans.nearest("v", np.array([[-1.0], [1.0]]))
    found = {r.id: r.x for r in rows.select("id", label.alias("x")).collect()}
    assert found == {"tie": 0, "b": 1, "wide": None, "none": None}


def test_summed_by_shuffle_or_by_driver(points, monkeypatch):
    x = blobs()
    direct = kmeans.fit_from(points(x), x[:3].copy(), max_iter=3)
    monkeypatch.setattr(partials, "DIRECT_BYTES", 0)
    shuffled = kmeans.fit_from(points(x), x[:3].copy(), max_iter=3)
    np.testing.assert_allclose(direct.centers, shuffled.centers)


def test_batches_keep_order_and_bound():
    assert partials.batches_of([3, 4, 5, 20, 1], lambda x: x, 8) == [[3, 4], [5], [20], [1]]


def test_secondary_keys(points):
    x, y = blobs(1, 150, centres=4, spread=0.05), blobs(2, 100, centres=6, spread=0.05) + 40
    label = [0] * 150 + [1] * 100
    table = points(np.vstack([x, y]), g=label)
    keys = fit_secondary(table, "g", sizes=list(range(1, 20)), restarts=5)
    assert keys.sweep.count() == 38
    assert {r.g: r.elbow for r in keys.elbow.collect()} == {g: len(c) for g, c in keys.centers.items()}
    rows = keys.label(table, "g").collect()
    for r in rows:
        own = keys.centers[r.g]
        assert r.secondary_cluster_id == ((own - np.array(r.reduced)) ** 2).sum(axis=1).argmin()


def test_secondary_without_elbow(points):
    table = points(np.zeros((12, 2)), g=[0] * 12)
    assert fit_secondary(table, "g", sizes=[1, 2, 3], restarts=1).centers == {}
    keys = fit_secondary(table, "g", sizes=[1, 2, 3], restarts=1, without_elbow=2)
    assert len(keys.centers[0]) == 2
    none = fit_secondary(table, "g", sizes=[1, 2, 3], restarts=1)
    assert none.label(table, "g").where("secondary_cluster_id IS NOT NULL").count() == 0


def starts_of(table, sizes, seed=0):
    with working_copy(kmeans.grouped(table, "reduced", None), 2) as blocks:
        return kmeans.spread_starts(blocks, sizes, seed)


def test_spread_starts_reach_far_rows_and_ignore_the_layout(points):
    rng = np.random.default_rng(12)
    far = np.array([[50.0, 0.0], [0.0, 80.0], [-60.0, -60.0]])
    matrix = np.vstack([rng.normal(size=(600, 2)), np.repeat(far, 3, axis=0) + rng.normal(scale=0.1, size=(9, 2))])
    one, other = (starts_of(points(matrix, partitions=n), [1, 4, 9]) for n in (1, 5))
    for k in (1, 4, 9):
        assert one[k].shape == (k, 2)
        np.testing.assert_allclose(one[k], other[k])
    # Every far group has a start of its own, which drawing rows alike would hardly give it.
    assert (np.linalg.norm(far[:, None] - one[4][None], axis=2).min(axis=1) < 1).all()
    assert np.linalg.norm(one[1][0] - matrix.mean(axis=0)) < 2


def test_spread_starts_of_few_values(points):
    starts = starts_of(points(np.array([[1.0, 2.0]] * 30 + [[3.0, 4.0]] * 10)), [1, 2, 5])
    np.testing.assert_allclose(starts[1], [[1.5, 2.5]])
    assert sorted(map(tuple, starts[2])) == [(1.0, 2.0), (3.0, 4.0)]
    assert starts[5].shape == (5, 2) and {tuple(row) for row in starts[5]} == {(1.0, 2.0), (3.0, 4.0)}


@pytest.mark.parametrize("sizes", [[1, 2, 6, 20], [300]], ids=["few", "more than 8 bits"])
def test_marks_spare_distances_and_change_nothing(points, split, sizes):
    x = np.vstack([blobs(rows=700, centres=6, spread=1.2), np.ones((9, 4))])
    group = np.arange(len(x)) % 2
    starts = {(g, k): x[group == g][:k].copy() for g in (0, 1) for k in sizes}

    def fits(unmarked):
        made = [kmeans.Fit(g, k, 0, start.copy(), 1e-9) for (g, k), start in sorted(starts.items())]
        with working_copy(kmeans.grouped(points(x, g=group.tolist()), "reduced", "g"), 4) as blocks:
            return kmeans.run_lloyd(blocks, made, 60, unmarked=unmarked)

    plain, marked = fits(float("inf")), fits(2)
    for a, b in zip(plain, marked):
        np.testing.assert_allclose(a.centers, b.centers, rtol=1e-9, atol=1e-12)
        assert a.iterations == b.iterations and b.sse == pytest.approx(a.sse)
        np.testing.assert_array_equal(a.sizes, b.sizes)
        assert a.distances == a.k * a.sizes.sum() * (a.iterations + 1)
    if sizes != [300]:
        assert sum(b.distances for b in marked) < 0.7 * sum(a.distances for a in plain)


def test_marks_with_equal_rows_and_lost_centres(points):
    """Centres at one place never have a gap, and a refilled centre moves far: both are settled by distances."""
    x = np.vstack([np.zeros((30, 2)), np.ones((30, 2)), [[9.0, 9.0]], [[1e9, 1e9]]])

    def fits(unmarked):
        made = [kmeans.Fit(0, 5, 0, np.array([[0.0, 0.0], [0.0, 0.0], [1.0, 1.0], [1.0, 1.0], [5.0, 5.0]]))]
        with working_copy(kmeans.grouped(points(x), "reduced", None), 2) as blocks:
            return kmeans.run_lloyd(blocks, made, 20, unmarked=unmarked)[0]

    plain, marked = fits(float("inf")), fits(0)
    np.testing.assert_allclose(marked.centers, plain.centers)
    np.testing.assert_array_equal(marked.sizes, plain.sizes)
    assert marked.sse == pytest.approx(plain.sse)


def test_the_driver_gets_no_tallies(points, monkeypatch):
    """What the driver collects in all passes together is less than one state of one task, and no more with many parts than with few."""
    x = blobs(rows=600, centres=9, spread=1.5)
    collect, sent = RDD.collect, []

    def counted(self):
        found = collect(self)
        sent.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    fits = [kmeans.Fit(0, 40, r, x[r : r + 40].copy()) for r in range(20)]
    monkeypatch.setattr(partials, "FAN", 2)
    with working_copy(kmeans.grouped(points(x, partitions=5), "reduced", None), 4) as blocks:
        sent.clear()
        done = kmeans.run_lloyd(blocks, fits, 12)
    assert all(fit.sizes.sum() == 600 and fit.iterations > 3 for fit in done)
    assert sum(sent) < 20 * 40 * 6 * 8


def test_the_driver_keeps_nothing_of_past_passes(points):
    """PySpark never forgets an accumulator, so what fits told of each pass would stay with the driver to its end."""
    before = set(accumulators._accumulatorRegistry)
    fits = kmeans.fit_many(points(blobs(rows=400)), [3, 7], restarts=2, max_iter=12)
    assert max(fit.iterations for fit in fits) > kmeans.UNMARKED + 1
    new = [accumulators._accumulatorRegistry[n] for n in set(accumulators._accumulatorRegistry) - before]
    assert len(new) <= 1 and not any(found.value for found in new)


def test_new_marks_are_a_move_of_their_own(points, monkeypatch):
    """As many jobs pass over the rows as the slowest fit makes moves, and one that measures: making marks is no pass beside these."""
    x, taken = blobs(rows=600, centres=9, spread=1.5), []
    for name in ("mark", "one_pass"):
        plain = getattr(kmeans._Run, name)
        monkeypatch.setattr(kmeans._Run, name, lambda self, name=name, plain=plain: (taken.append(name), plain(self))[1])
    with working_copy(kmeans.grouped(points(x), "reduced", None), 4) as blocks:
        done = kmeans.run_lloyd(blocks, [kmeans.Fit(0, k, 0, x[:k].copy()) for k in (3, 12)], 9)
    assert "mark" in taken and len(taken) == 1 + max(fit.iterations for fit in done)


@pytest.mark.parametrize("scale", [1e-25, 1.0, 1e15, 1e25, 1e120])
def test_single_precision_hides_no_nearest_centre(scale):
    """Centres that single precision cannot tell apart, and numbers that it does not hold."""
    rng = np.random.default_rng(4)
    centers = np.repeat(rng.normal(size=(7, 5)), 2, axis=0)
    centers[1::2] += 1e-9 * rng.normal(size=(7, 5))
    rows = np.vstack([rng.normal(size=(500, 5)), centers]) * scale
    centers *= scale
    made = kmeans._Centers(centers)
    away = ((rows[:, None] / scale - centers[None] / scale) ** 2).sum(axis=2)
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        chosen = made.nearest(rows, *kmeans._single(rows))
        ((labels, gaps),) = kmeans._two_nearest(rows, [made])
    line = np.arange(len(rows))
    np.testing.assert_allclose(away[line, chosen], away.min(axis=1), rtol=1e-12, atol=1e-13)
    np.testing.assert_array_equal(labels, chosen)
    two = np.sqrt(np.sort(away, axis=1)[:, :2]) * scale
    assert (gaps <= two[:, 1] - two[:, 0]).all()


def test_a_sweep_passes_over_even_splits(spark, monkeypatch):
    """One split holds nearly all rows, and there is one split more than cores: every core gets its share for all passes."""
    x, seen = blobs(), []
    splits = [[([float(v) for v in row],) for row in part] for part in (x, *(x[n : n + 1] + 9 for n in range(4)))]
    table = spark.createDataFrame(spark.sparkContext.parallelize(splits, 5).flatMap(list), "reduced array<double>")
    assert table.rdd.getNumPartitions() == 5
    real = kmeans.fit_blocks

    def watched(blocks, *rest):
        seen.append(blocks.rdd.mapPartitions(lambda held: [sum(len(rows) for _, rows in held)]).collect())
        return real(blocks, *rest)

    monkeypatch.setattr(kmeans, "fit_blocks", watched)
    fits = kmeans.fit_many(table, [2, 3], restarts=1)
    assert [fit.sizes.sum() for fit in fits] == [len(x) + 4] * 2
    assert len(seen[0]) == 4 and sum(seen[0]) == len(x) + 4 and max(seen[0]) <= len(x) / 4 + 5
    size = 8 * 4 * (len(x) + 4)
    for limit, splits in ((size / 8, 8), (size / 100, 5)):
        monkeypatch.setattr(partials, "EVEN_BYTES", int(limit))
        kmeans.fit_many(table, [2], restarts=1)
        assert len(seen[-1]) == splits and sum(seen[-1]) == len(x) + 4
