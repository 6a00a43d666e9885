import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshoal.operators.features import fit_features
from vecshoal.operators.mixture import Mixture
from vecshoal.plans.index import IndexModel, fit_index
from vecshoal.plans.keyed import KeyedIndex, KeyedModel, fit_keys
from vecshoal.sources.schema import KEYED


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    middle = rng.normal(scale=6, size=(5, 6))
    return middle[rng.integers(5, size=240)] + rng.normal(size=(240, 6))


@pytest.fixture
def table(items, matrix):
    return items([(f"i{i:04d}", row, None) for i, row in enumerate(matrix)]).drop("cluster_id").repartition(3)


@pytest.fixture
def model(table):
    """Three groups, of which one is not divided."""
    features = fit_features(table, share=None, components=6)
    rng = np.random.default_rng(6)
    groups = rng.normal(size=(3, 6))
    return KeyedModel(
        IndexModel(features, rng.normal(size=(4, 6)), {}),
        Mixture(np.full(3, 1 / 3), groups, np.array([np.eye(6)] * 3)),
        {0: rng.normal(size=(4, 6)), 2: rng.normal(size=(2, 6))},
    )


def by_hand(model, matrix, lists):
    """Reduced rows, and the groups and nearest lists of each."""
    weights, offset = model.features.projection()
    reduced = matrix @ weights - offset
    groups = ((reduced[:, None] - model.mixture.means[None]) ** 2).sum(axis=2).argmin(axis=1)
    near = []
    for row, group in zip(reduced, groups):
        own = model.inside.get(int(group))
        near.append([0] if own is None else list(((row - own) ** 2).sum(axis=1).argsort(kind="stable")[:lists]))
    return reduced, groups, near


@pytest.mark.parametrize("lists", [1, 2, 9])
def test_search_reads_the_nearest_lists(spark, table, matrix, model, scratch, lists):
    path = scratch("keyed")
    KeyedIndex.build(table, path, model)
    index = KeyedIndex.open(spark, path)
    assert index.table.read().schema.names == KEYED.names
    reduced, groups, near = by_hand(model, matrix, lists)
    assert len(set(groups)) == 3
    for row in index.table.read().collect():
        number = int(row.id[1:])
        assert (row.gmm_cluster_id, row.secondary_cluster_id) == (groups[number], near[number][0])
    unit = reduced / np.linalg.norm(reduced, axis=1, keepdims=True)
    found = {}
    for row in index.search(table.select(F.col("id").alias("query_id"), "encd"), 5, lists=lists).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.id, row.similarity))
    for q in range(len(matrix)):
        inside = [i for i in range(len(matrix)) if groups[i] == groups[q] and near[i][0] in near[q]]
        best = sorted(((-round(float(unit[i] @ unit[q]), 9), f"i{i:04d}") for i in inside))[:5]
        got = sorted(found[f"i{q:04d}"])
        assert [r for r, _, _ in got] == list(range(1, len(best) + 1))
        assert [(-round(s, 9), i) for _, i, s in got] == best


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_both_keys_prune_folders(spark, table, matrix, model, scratch):
    path = scratch("keyed")
    index = KeyedIndex.build(table, path, model)
    found = index.search_one(matrix[3], 4)
    filters = [line for line in plan_of(found).split("PartitionFilters: ")[1:]]
    assert all(key in filters[0].split("]")[0] for key in ("gmm_cluster_id", "secondary_cluster_id"))
    assert "encd" not in plan_of(found).split("ReadSchema: ")[1].split(">")[0]
    _, groups, near = by_hand(model, matrix[3:4], 1)
    folder = f"gmm_cluster_id={groups[0]}/secondary_cluster_id={near[0][0]}"
    assert found.orderBy("rank").first().id == "i0003"
    assert any(folder in file for file in index.table.files())


def test_misfits_and_upserts(spark, items, table, matrix, model, scratch):
    bad = items([("short", [1], 0), ("none", None, 0), ("nan", [float("nan")] * 6, 0)]).drop("cluster_id")
    index = KeyedIndex.build(table.unionByName(bad), scratch("keyed"), model)
    assert {r.id: r.reason for r in index.rejected().collect()} == {"short": "wrong width", "none": "missing vector", "nan": "not a number"}
    index.upsert(items([("i0000", matrix[1], 0), ("short", matrix[2], 0)]).drop("cluster_id"), None)
    rows = {r.id: r for r in index.table.read().collect()}
    assert len(rows) == 243
    keys = lambda r: (r.cluster_id, r.gmm_cluster_id, r.secondary_cluster_id)
    assert keys(rows["i0000"]) == keys(rows["i0001"]) and keys(rows["short"]) == keys(rows["i0002"])
    asked = spark.createDataFrame([(1, None), (2, [1.0])], "query_id long, encd array<double>")
    assert index.search(asked, 3, lists=2).count() == 0


def test_fitted_keys(spark, table, scratch):
    model = fit_keys(table, fit_index(table, k=3, restarts=2), components=2, sizes=[1, 2, 3, 4], without_elbow=2, restarts=2)
    assert model.mixture.size == 2 and all(len(own) in (1, 2, 3, 4) for own in model.inside.values())
    path = scratch("model")
    model.save(spark, path)
    again = KeyedModel.load(spark, path)
    np.testing.assert_array_equal(again.mixture.covariances, model.mixture.covariances)
    assert set(again.inside) == set(model.inside) and again.stride == model.stride
    for group, own in model.inside.items():
        np.testing.assert_array_equal(again.inside[group], own)
    one, other = (m.label(table).select("id", "gmm_cluster_id", "secondary_cluster_id").collect() for m in (model, again))
    assert sorted(one) == sorted(other)
    assert again.features.left_out == model.features.left_out
