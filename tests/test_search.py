import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecshoal.operators import search


def brute(rows, queries, k):
    """Every pair of a query and an item of its cluster, ranked."""
    out = {}
    for name, q, cluster in queries:
        scored = []
        for id_, v, c in rows:
            if c == cluster and v is not None and len(v) == len(q):
                size = np.linalg.norm(q) * np.linalg.norm(v)
                scored.append((round(float(np.dot(q, v) / size), 12) if size else 0.0, id_))
        scored.sort(key=lambda pair: (-pair[0], pair[1]))
        out[name] = [(i + 1, id_, s) for i, (s, id_) in enumerate(scored[:k])]
    return {name: found for name, found in out.items() if found}


def answers(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.id, r.similarity))
    return out


def same(found, expected):
    assert found.keys() == expected.keys()
    for name in expected:
        assert [f[:2] for f in found[name]] == [e[:2] for e in expected[name]], name
        np.testing.assert_allclose([f[2] for f in found[name]], [e[2] for e in expected[name]], atol=1e-9)


def query_table(spark, queries):
    rows = [(name, None if v is None else [float(x) for x in v], c) for name, v, c in queries]
    return spark.createDataFrame(rows, "query_id long, encd array<double>, cluster_id int")


def sample(seed=0, rows=400, width=5, clusters=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, width))
    label = np.where(rng.random(rows) < 0.5, 0, rng.integers(clusters, size=rows))
    return [(f"i{i:04d}", x[i], int(label[i])) for i in range(rows)]


@pytest.mark.parametrize("k, size", [(1, 1 << 20), (7, 1 << 20), (500, 1 << 20), (7, 1000)])
def test_same_as_all_pairs(spark, items, k, size):
    rows = sample()
    rng = np.random.default_rng(9)
    queries = [(i, rng.normal(size=5), int(rng.integers(4))) for i in range(60)]
    found = search.top_k(items(rows).repartition(5), query_table(spark, queries), k, query_bytes=size)
    same(answers(found), brute(rows, queries, k))


def test_a_third_of_the_items_are_copies(spark, items):
    rows = sample(rows=900)
    rows = [(id_, rows[0][1] if i % 3 == 0 else v, 0) for i, (id_, v, _) in enumerate(rows)]
    queries = [(0, rows[0][1], 0), (1, rows[1][1], 0), (2, -rows[0][1], 0)]
    found = search.top_k(items(rows).repartition(7), query_table(spark, queries), 20)
    same(answers(found), brute(rows, queries, 20))


def test_small_blocks_and_many_prunes(spark, items, monkeypatch):
    monkeypatch.setattr(search, "_CELLS", 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        rows = sample(rows=300)
        queries = [(i, rows[i][1], rows[i][2]) for i in range(40)]
        found = search.top_k(items(rows).coalesce(1), query_table(spark, queries), 3)
        same(answers(found), brute(rows, queries, 3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edges(spark, items):
    rows = [
        ("zero", [0, 0], 0), ("a", [1, 0], 0), ("b", [1, 0], 0), ("short", [1], 0), ("none", None, 0), ("lone", [2, 2], 1),
    ]
    queries = [(1, [1, 0], 0), (2, [0, 0], 0), (3, [1, 1], 1), (4, [1, 1], 9), (5, None, 0), (6, [1, 1], None)]
    found = answers(search.top_k(items(rows), query_table(spark, queries), 10, width=2))
    assert found[1] == [(1, "a", 1.0), (2, "b", 1.0), (3, "zero", 0.0)]
    assert [f[1:] for f in found[2]] == [("a", 0.0), ("b", 0.0), ("zero", 0.0)]
    assert found[3] == [(1, "lone", pytest.approx(1.0))]
    assert set(found) == {1, 2, 3}


def test_no_queries(spark, items):
    assert search.top_k(items(sample()), query_table(spark, []), 5).count() == 0


def test_a_repeated_query_is_answered_once(spark, items):
    rows = sample()
    queries = [(1, rows[0][1], rows[0][2])] * 50 + [(2, rows[1][1], rows[1][2])]
    found = search.top_k(items(rows), query_table(spark, queries), 4)
    same(answers(found), brute(rows, queries, 4))


def test_single_equals_batch(spark, items):
    rows = sample()
    table = items(rows)
    for id_, v, c in rows[:3]:
        one = [(r["rank"], r.id, r.similarity) for r in search.top_k_single(table, v, 9, c).orderBy("rank").collect()]
        many = answers(search.top_k(table, query_table(spark, [(1, v, c)]), 9))[1]
        assert one[0][1] == id_
        same({1: one}, {1: many})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.integers(1, 6), st.integers(1, 12))
def test_small_whole_numbers_tie_often(spark, items, seed, k, partitions):
    rng = np.random.default_rng(seed)
    rows = [(f"i{i:03d}", rng.integers(-1, 2, size=2), int(rng.integers(2))) for i in range(80)]
    queries = [(i, rng.integers(-1, 2, size=2), int(rng.integers(2))) for i in range(9)]
    found = search.top_k(items(rows).repartition(partitions), query_table(spark, queries), k)
    same(answers(found), brute(rows, queries, k))


def test_result_lists(spark, items):
    rows = sample()
    found = search.top_k(items(rows), query_table(spark, [(1, rows[0][1], 0), (2, rows[1][1], 1)]), 3)
    for r in search.result_lists(found).collect():
        ranked = found.where(F.col("query_id") == r.query_id).orderBy("rank").collect()
        assert r.names == [x.img_name for x in ranked]
        assert r.similarities == [x.similarity for x in ranked]
        assert r.urls.split("\n") == [f"u/{x.id}.jpg" for x in ranked]


def test_refused_queries(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, " \t\n"), (4, " cat ")], "query_id int, text string")
    good, refused = search.split_queries(rows)
    assert [r.query_id for r in good.collect()] == [4]
    assert {r.query_id: r.reason for r in refused.collect()} == {1: "missing query", 2: "empty query", 3: "blank query"}


def test_copies_do_not_grow_with_small_blocks(spark, items):
    """Blocks of ten rows of a cluster of a thousand are not a hundred copies of everything."""
    rows = sample(rows=900)
    queries = [(i, v, c) for i, (_, v, c) in enumerate(rows)]
    table, asked = items(rows), query_table(spark, queries)
    copies = search.parts_of(table, asked, 10, 10).agg(F.max("item_parts"), F.max("query_parts")).first()
    assert max(copies) <= search.FEW_PARTS
    same(answers(search.top_k(table, asked, 5, query_bytes=1, block_items=10, block_queries=10)), brute(rows, queries, 5))
