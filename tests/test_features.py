import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshoal.operators import aggregates, features, partials
from vecshoal.operators.features import FeatureModel, component_count, fit_features


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    return rng.normal(size=(200, 3)) @ rng.normal(size=(3, 6)) + 0.3 * rng.normal(size=(200, 6)) + 1000.0


def test_fit_matches_svd(points, matrix):
    model = fit_features(points(matrix), "reduced")
    scaled = (matrix - matrix.mean(axis=0)) / matrix.std(axis=0)
    power = np.linalg.svd(scaled, compute_uv=False) ** 2
    ratio = power / power.sum()
    np.testing.assert_allclose(model.mean, matrix.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(model.deviation, matrix.std(axis=0), rtol=1e-9)
    np.testing.assert_allclose(model.ratio, ratio, atol=1e-9)
    assert model.kept == int(np.searchsorted(np.cumsum(ratio), 0.95, side="right")) + 1


def test_projection_keeps_scaled_distances(points, matrix):
    model = fit_features(points(matrix), "reduced", share=None, components=6)
    rows = points(matrix).select("id", model.project("reduced").alias("r"), model.standardise("reduced").alias("s"))
    found = rows.orderBy("id").collect()
    reduced, scaled = np.array([r.r for r in found]), np.array([r.s for r in found])
    np.testing.assert_allclose(scaled, (matrix - matrix.mean(axis=0)) / matrix.std(axis=0), atol=1e-9)
    np.testing.assert_allclose(reduced @ reduced.T, scaled @ scaled.T, atol=1e-7)
    np.testing.assert_allclose(reduced.var(axis=0) / 6, model.ratio, atol=1e-9)


def test_curve_grows_to_one(spark, points, matrix):
    curve = fit_features(points(matrix), "reduced").variance_curve(spark).orderBy("component").collect()
    total = [r.cumulative for r in curve]
    assert [r.component for r in curve] == [1, 2, 3, 4, 5, 6]
    assert total == sorted(total) and total[-1] == pytest.approx(1.0)


def test_component_count_needs_more_than_the_share():
    assert component_count(np.array([0.5, 0.25, 0.25]), 0.75) == 3
    assert component_count(np.array([0.5, 0.25, 0.25]), 0.74) == 2
    assert component_count(np.array([1.0]), 0.95) == 1


def test_constant_dimension(points):
    matrix = np.column_stack([np.full(50, 0.1), np.random.default_rng(0).normal(size=(50, 2))])
    model = fit_features(points(matrix), "reduced", share=None, components=3)
    assert model.deviation[0] == 0.0
    assert model.ratio[-1] == pytest.approx(0.0)
    found = points(matrix).select(model.standardise("reduced").alias("s")).collect()
    assert max(abs(r.s[0]) for r in found) < 1e-12


def test_misfit_vectors_are_left_out(spark, points, matrix):
    rows = points(matrix).unionByName(
        spark.createDataFrame([("short", [1.0]), ("none", None)], "id string, reduced array<double>")
    )
    model = fit_features(rows, "reduced", width=6)
    assert model.rows == 200
    out = {r.id: r.x for r in rows.select("id", model.project("reduced").alias("x")).collect()}
    assert out["short"] is None and out["none"] is None
    assert sum(v is not None for v in out.values()) == 200


def test_the_common_width_is_found(spark, points, matrix):
    short = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", None)], "id string, reduced array<double>")
    model = fit_features(short.coalesce(1).unionByName(points(matrix)), "reduced")
    assert (model.width, model.rows, model.left_out) == (6, 200, 3)
    # Short vectors in front, more of them than any prefix would hold, do not win over more long ones.
    many = spark.createDataFrame([(f"s{n}", [1.0, 2.0]) for n in range(190)], "id string, reduced array<double>")
    model = fit_features(many.coalesce(1).unionByName(points(matrix)), "reduced")
    assert (model.width, model.rows, model.left_out) == (6, 200, 190)
    with pytest.raises(ValueError):
        fit_features(short.where("id = 'c'"), "reduced")


def test_save_and_load(spark, points, matrix, scratch):
    model = fit_features(points(matrix), "reduced")
    path = scratch("features")
    model.save(spark, path)
    back = FeatureModel.load(spark, path)
    assert (back.kept, back.rows) == (model.kept, model.rows)
    np.testing.assert_array_equal(back.loadings, model.loadings)
    np.testing.assert_array_equal(back.deviation, model.deviation)


def test_dimension_stats_are_population(points, matrix):
    stats = aggregates.dimension_stats(points(matrix), "reduced").orderBy("dim").collect()
    np.testing.assert_allclose([r["mean"] for r in stats], matrix.mean(axis=0))
    np.testing.assert_allclose([r["std"] for r in stats], matrix.std(axis=0), rtol=1e-9)


def test_misfit_vectors_leave_aggregates_alone(spark, items, matrix):
    rows = [(f"i{n}", v, n % 3) for n, v in enumerate(matrix)]
    odd = [("short", [1.0], 0), ("none", None, 1), ("nan", [float("nan")] * 6, 2), ("inf", [float("inf")] * 6, 0)]
    for of in (aggregates.cluster_centroids, aggregates.own_mean_sse, aggregates.dimension_stats):
        found, want = (sorted(map(tuple, of(items(some)).collect())) for some in (rows + odd, rows))
        assert len(found) == len(want)
        for a, b in zip(found, want):
            np.testing.assert_allclose(np.hstack(a), np.hstack(b))
    centroids = aggregates.cluster_centroids(items(rows))
    sizes = {r.cluster_id: r["size"] for r in aggregates.centroid_sse(items(rows + odd[:2]), centroids).collect()}
    assert sizes == {r.cluster_id: r["size"] for r in centroids.collect()}


def test_cluster_of_one_row(items):
    rows = items([("a", [1, 2], 0), ("b", [3, 4], 1), ("c", [5, 8], 1), ("n", [0, 0], None), ("v", None, 1)])
    sse = {r.cluster_id: (r.size, r.sse) for r in aggregates.own_mean_sse(rows).collect()}
    assert sse == {0: (1, 0.0), 1: (2, 10.0)}
    means = aggregates.cluster_centroids(rows)
    assert {r.cluster_id: r.centroid for r in means.collect()} == {0: [1.0, 2.0], 1: [4.0, 6.0]}
    assert [tuple(r) for r in aggregates.cluster_sizes(rows).collect()] == [(1, 3), (0, 1)]


@pytest.mark.parametrize("limit", [10_000, 1])
def test_attach_by_broadcast_and_by_salt(spark, items, limit):
    from vecshoal.operators.joins import attach

    rows = items([(f"i{i}", [i, 0], 0 if i % 3 else i % 7) for i in range(60)])
    means = aggregates.cluster_centroids(rows).select("cluster_id", F.col("centroid").alias("cluster_centroid"))
    joined = attach(rows, means, "cluster_id", spread="id", salts=4, max_rows=limit)
    expected = {r.cluster_id: r.cluster_centroid for r in means.collect()}
    found = joined.collect()
    assert len(found) == 60
    assert all(r.cluster_centroid == expected[r.cluster_id] for r in found)


def test_statistics_without_a_width_read_the_table_once(spark, items, matrix, tmp_path):
    rows = [(f"i{n}", row, n % 3) for n, row in enumerate(matrix.tolist())]
    odd = [("s1", [1.0], 0), ("s2", [None], 0), ("s3", [2.0], 1), ("s4", None, 2), ("s5", [float("nan")] * matrix.shape[1], 1)]
    spark.createDataFrame(rows + odd, "id string, encd array<double>, cluster_id int").write.parquet(f"{tmp_path}/items")
    table = spark.read.parquet(f"{tmp_path}/items")
    width = matrix.shape[1]
    for of in (aggregates.cluster_centroids, aggregates.own_mean_sse, aggregates.dimension_stats):
        found = of(table)
        got = sorted(map(tuple, found.collect()))
        assert got == sorted(map(tuple, of(table, width=width).collect()))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Scan parquet") == 1 and "Reused" in plan


def test_the_least_of_equally_common_widths_counts(spark):
    rows = [([1.0, 2.0], 0), ([3.0], 0), ([5.0], 1), ([3.0, 4.0], None), ([], 0), (None, 0)]
    table = spark.createDataFrame(rows, "encd array<double>, cluster_id int")
    assert sorted(map(tuple, aggregates.cluster_centroids(table).collect())) == [(0, [3.0], 1), (1, [5.0], 1)]
    # Broken vectors count for their width, and a group of nothing else has no mean.
    table = table.union(spark.createDataFrame([([float("inf"), 1.0], 7)], table.schema))
    assert sorted(map(tuple, aggregates.cluster_centroids(table).collect())) == [(0, [1.0, 2.0], 1)]
    assert aggregates.dimension_stats(table.where("encd is null")).count() == 0


def test_one_scan_fits_features_of_the_first_width(points, matrix, spark, monkeypatch):
    calls = []
    summed = features.sum_over_tasks
    monkeypatch.setattr(features, "sum_over_tasks", lambda *args: calls.append(1) or summed(*args))
    fit_features(points(matrix), "reduced")
    assert len(calls) == 1
    short = spark.createDataFrame([("a", [1.0])], "id string, reduced array<double>")
    assert fit_features(short.coalesce(1).unionByName(points(matrix)), "reduced").width == 6
    assert len(calls) == 3


def test_a_working_copy_counts_its_widths(spark):
    rows = [(0, [1.0, 2.0]), (0, [3.0]), (1, [float("nan")]), (1, [5.0]), (1, None), (2, [3.0, 4.0])]
    table = spark.createDataFrame(rows, "g int, v array<double>")
    with partials.working_copy(table) as blocks:
        held = sorted((int(g), *map(float, row)) for groups, x in blocks.rdd.collect() for g, row in zip(groups, x))
        assert (blocks.width, held) == (1, [(0, 3.0), (1, 5.0)])
    with partials.working_copy(table, 2) as blocks:
        assert blocks.width == 2 and sum(len(g) for g, _ in blocks.rdd.collect()) == 2
    with partials.working_copy(table.where("v is null")) as blocks:
        assert blocks.width == 0 and not blocks.rdd.collect()


def vectors_of(spark, x, partitions):
    return spark.createDataFrame([([float(v) for v in row],) for row in x], "encd array<double>").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7])
def test_factors_equal_sums(spark, partitions):
    x = np.random.default_rng(4).normal(size=(400, 12)) @ np.random.default_rng(5).normal(size=(12, 12)) + 1e3
    x[:, 3] = 7.0
    rows = vectors_of(spark, x, partitions)
    rows = rows.unionByName(spark.createDataFrame([(None,), ([1.0],), ([float("nan")] * 12,)], "encd array<double>"))
    sums, factors = fit_features(rows), fit_features(rows, factors=True)
    assert (factors.rows, factors.left_out, factors.kept) == (sums.rows, sums.left_out, sums.kept) == (400, 3, sums.kept)
    np.testing.assert_allclose(factors.mean, sums.mean, rtol=1e-12)
    np.testing.assert_allclose(factors.deviation, sums.deviation, rtol=1e-9)
    np.testing.assert_allclose(factors.ratio, sums.ratio, rtol=1e-9, atol=1e-14)
    np.testing.assert_allclose(factors.loadings[:11], sums.loadings[:11], rtol=1e-6, atol=1e-7)


def test_factors_hold_a_near_singular_table(spark, monkeypatch):
    monkeypatch.setattr("vecshoal.operators.features.DIRECT_BYTES", 0)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3000, 3))
    x = np.hstack([base, base[:, :2] + 1e-10 * rng.normal(size=(3000, 2))])
    model = fit_features(vectors_of(spark, x, 5), factors=True)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    lengths = np.linalg.svd(z, compute_uv=False) ** 2
    np.testing.assert_allclose(model.ratio, lengths / lengths.sum(), rtol=1e-4)
    assert 0 < model.ratio[-1] < 1e-18


def test_factors_of_fewer_rows_than_columns(spark):
    x = np.random.default_rng(7).normal(size=(3, 6))
    model = fit_features(vectors_of(spark, x, 2), factors=True, share=None, components=6)
    assert model.loadings.shape == (6, 6)
    np.testing.assert_allclose(model.ratio[2:], 0.0, atol=1e-28)
    one = fit_features(vectors_of(spark, x[:1], 1), factors=True)
    assert one.rows == 1 and (one.deviation == 0).all()
