import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecshoal.operators import codes, search
from vecshoal.operators.features import fit_features
from vecshoal.plans.coded import CodedIndex
from vecshoal.plans.index import IndexModel, SearchIndex
from vecshoal.sources.schema import CODED


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 40), st.sampled_from([1e-200, 1e-3, 1.0, 1e150]))
def test_bounds_hold(seed, width, size):
    rng = np.random.default_rng(seed)
    rows = np.vstack([rng.normal(size=(20, width)) ** 3 * size, np.eye(width)[:1], np.zeros((1, width))])
    found, scale, slack = codes.encode(rows)
    unit = search._unit(rows)
    about = unit @ (found * scale[:, None]).T
    assert (np.abs(about - unit @ unit.T) <= slack[None, :]).all()
    assert slack.max() < np.sqrt(width) / codes.LARGEST + 1e-9


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(8)
    return rng.normal(size=(12, 24))[rng.integers(12, size=1500)] * 3 + rng.normal(size=(1500, 24))


@pytest.fixture
def indexes(items, matrix, scratch):
    rows = [(f"i{i:04d}", row, None) for i, row in enumerate([*matrix, matrix[0], matrix[0], np.zeros(24)])]
    table = items([*rows, ("short", [1.0], None), ("none", None, None)]).drop("cluster_id").repartition(4)
    features = fit_features(table.where(F.array_size("encd") == 24), share=None, components=24)
    model = IndexModel(features, np.zeros((2, 24)) + np.array([[0.0], [1e6]]), {})
    return SearchIndex.build(table, scratch("plain"), model), CodedIndex.build(table, scratch("coded"), model)


def asked(spark, matrix, numbers):
    return spark.createDataFrame([(n, [float(x) for x in matrix[n]]) for n in numbers], "query_id long, encd array<double>")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_answers_from_fewer_vectors(spark, indexes, matrix, scratch):
    plain, coded = indexes
    assert coded.table.read().schema.names == CODED.names
    queries = asked(spark, matrix, [0, 7, 20, 31])
    assert rows_of(coded.search(queries, 5)) == rows_of(plain.search(queries, 5))
    read = coded.candidates(queries, 5)
    assert read.groupBy("query_id").count().where("count < 5").count() == 0
    assert read.select("id").distinct().count() < 0.15 * len(matrix)
    scan = read._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split(">")[0]
    assert "reduced" not in scan and "encd" not in scan and "code:binary" in scan
    # Equal vectors and more answers than candidates of any bound.
    assert rows_of(coded.search(queries, 2000)) == rows_of(plain.search(queries, 2000))
    assert coded.rejected().count() == 2


def test_ways_of_reading_candidates(spark, indexes, matrix, monkeypatch):
    plain, coded = indexes
    queries = asked(spark, matrix, range(30))
    want = rows_of(plain.search(queries, 3))
    monkeypatch.setattr(codes, "LISTED_IDS", 2)
    assert rows_of(coded.search(queries, 3)) == want
    monkeypatch.setattr(codes, "local_copy", lambda ids: None)
    assert rows_of(coded.search(queries, 3)) == want
    monkeypatch.setattr(search, "QUERY_BYTES", 1)
    assert rows_of(coded.search(queries, 3)) == want
    assert rows_of(coded.search(queries, 3, space="raw")) == rows_of(plain.search(queries, 3, space="raw"))
    assert coded.search(queries.limit(0), 3).count() == 0


def test_upsert_renews_codes(spark, items, indexes, matrix):
    _, coded = indexes
    coded.upsert(items([("i0003", matrix[0], 0), ("new", matrix[7], 0)]).drop("cluster_id"), None)
    found = coded.search(asked(spark, matrix, [0, 7]), 6).collect()
    assert "i0003" in [r.id for r in found if r.query_id == 0] and "new" in [r.id for r in found if r.query_id == 7]


def test_queries_dealt_to_parts_lose_no_candidate(spark, indexes, matrix, monkeypatch):
    """Too many queries to send about: the pairs hold the answers, and with more answers asked for than items every pair is there."""
    plain, coded = indexes
    queries = asked(spark, matrix, range(40))
    monkeypatch.setattr(search, "TASK_ANSWERS", 1)
    monkeypatch.setattr(search, "PART_ITEMS", 300)
    monkeypatch.setattr(search, "PART_QUERIES", 7)
    best = {(r.query_id, r.id) for r in plain.search(queries, 3).collect()}
    found = coded.candidates(queries, 3)
    assert found.columns == ["query_id", "id", "lower", "upper"]
    pairs = {(r.query_id, r.id) for r in found.collect()}
    assert best <= pairs and len(pairs) < 0.3 * 40 * len(matrix)
    every = coded.candidates(queries, 1_000_000, exact=True)
    assert "Window" not in every._jdf.queryExecution().executedPlan().toString()
    assert every.where("similarity between lower and upper").count() == 40 * (len(matrix) + 3)


def test_pairs_are_counted_where_they_are_made(spark, indexes, matrix, monkeypatch):
    """No row per pair leaves the tasks, and counts are those of the pairs, whether a query meets all its items in one task or not."""
    _, coded = indexes
    queries = asked(spark, matrix, range(40))
    monkeypatch.setattr(search, "PART_QUERIES", 7)
    monkeypatch.setattr(codes, "_TILE", (3, 200))
    for most, part in ((1_000_000, 300), (3, 50_000), (3, 300)):
        monkeypatch.setattr(search, "PART_ITEMS", part)
        pairs = coded.candidates(queries, most, exact=True)
        for within in (0.1, float(pairs.selectExpr("percentile(upper - lower, 0.5)").first()[0])):
            sound = pairs.where(F.col("similarity").between(F.col("lower"), F.col("upper")) & (F.col("upper") - F.col("lower") < within)).count()
            counts = coded.candidates(queries, most, exact=True, within=within)
            assert counts.columns == ["cluster_id", "pairs", "held"]
            rows = counts.collect()
            assert (sum(r.pairs for r in rows), sum(r.held for r in rows)) == (pairs.count(), sound)
            assert most < 10 or len(rows) < 100
