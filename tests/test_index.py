import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshoal.functions.encode import HashingEncoder, encode_text
from vecshoal.operators import kmeans, search
from vecshoal.plans.index import SearchIndex, fit_index
from vecshoal.plans.text import search_text
from vecshoal.sources.schema import INDEXED
from vecshoal.streaming.serve import answer_stream
from tests.test_elbow import by_definition


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(2)
    middle = rng.normal(scale=5, size=(4, 8))
    return middle[rng.integers(4, size=300)] + rng.normal(size=(300, 8))


@pytest.fixture
def table(items, matrix):
    return items([(f"i{i:04d}", row, None) for i, row in enumerate(matrix)]).drop("cluster_id").repartition(3)


@pytest.fixture
def index(spark, table, scratch):
    path = scratch("index")
    SearchIndex.build(table, path, fit_index(table, k=4, restarts=3))
    return SearchIndex.open(spark, path)


def test_stored_items(index, matrix):
    rows = index.table.read()
    assert rows.schema.names == INDEXED.names
    found = rows.collect()
    assert len(found) == 300
    for r in found:
        assert r.cluster_centroid == list(index.model.centers[r.cluster_id])
    assert {r.cluster_id for r in found} == {0, 1, 2, 3}


def test_search_in_the_reduced_space(spark, index, table, matrix):
    features = index.model.features
    scaled = (matrix - matrix.mean(axis=0)) / matrix.std(axis=0)
    reduced = scaled @ features.loadings[: features.kept].T
    label = ((reduced[:, None] - index.model.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    unit = reduced / np.linalg.norm(reduced, axis=1, keepdims=True)
    found = index.search(table.select(F.col("id").alias("query_id"), "encd"), 5).collect()
    assert len(found) == 1500
    for r in found:
        q, i = int(r.query_id[1:]), int(r.id[1:])
        assert label[q] == label[i]
        assert r.similarity == pytest.approx(unit[q] @ unit[i], abs=1e-9)
        if r["rank"] == 1:
            assert q == i
    worst = {r.query_id: r.similarity for r in found if r["rank"] == 5}
    for name, floor in worst.items():
        q = int(name[1:])
        better = (unit[label == label[q]] @ unit[q] > floor + 1e-9).sum()
        assert better == 4


def test_one_query_and_raw_space(index, matrix):
    one = index.search_one(matrix[7], 3).orderBy("rank").collect()
    assert one[0].id == "i0007" and one[0].similarity == pytest.approx(1.0)
    raw = index.spark.createDataFrame([(7, [float(x) for x in matrix[7]])], "query_id long, encd array<double>")
    found = index.search(raw, 3, space="raw").orderBy("rank").collect()
    v = matrix[int(found[2].id[1:])]
    expected = v @ matrix[7] / np.linalg.norm(v) / np.linalg.norm(matrix[7])
    assert found[2].similarity == pytest.approx(expected)


def test_loaded_model_gives_the_stored_clusters(index):
    stored = index.table.read().select("encd", F.col("cluster_id").alias("was"))
    assert index.model.place(stored).where("cluster_id <> was").count() == 0


def test_upsert_labels_new_items(index, items, matrix):
    new = items([("i0000", matrix[1], 0), ("new", matrix[2], 0), ("new", matrix[3], 1)])
    index.upsert(new, ["cluster_id"])
    rows = {r.id: r for r in index.table.read().collect()}
    assert len(rows) == 301
    assert rows["i0000"].cluster_id == rows["i0001"].cluster_id
    np.testing.assert_allclose(rows["i0000"].reduced, rows["i0001"].reduced)
    assert rows["new"].encd == rows["i0003"].encd


def test_misfit_items_are_kept_aside(index, items, table, scratch):
    bad = items([("short", [1], 0), ("none", None, 0), ("nan", [float("nan")] * 8, 0), ("inf", [float("inf")] * 8, 0)])
    index.upsert(bad, None)
    assert index.table.read().count() == 304
    assert {r.id: r.reason for r in index.rejected().collect()} == {
        "short": "wrong width", "none": "missing vector", "nan": "not a number", "inf": "not a number",
    }
    found = index.search(table.select(F.col("id").alias("query_id"), "encd"), 300)
    assert found.where(F.col("id").isin("short", "none", "nan", "inf")).count() == 0
    mixed = table.unionByName(bad.drop("cluster_id"))
    again = SearchIndex.build(mixed, scratch("index"), fit_index(mixed, k=4, width=8, restarts=3))
    assert again.model.features.rows == 300
    assert again.rejected().count() == 4


def test_elbow_chooses_k(table):
    model = fit_index(table, sizes=list(range(1, 12)), restarts=3)
    sizes = [k for _, k in sorted(model.sweep)]
    assert sizes == list(range(1, 12))
    assert len(model.centers) == by_definition(sizes, [model.sweep[0, k] for k in sizes])


def test_no_elbow_needs_a_choice(items):
    rng = np.random.default_rng(0)
    flat = items([(f"i{i}", v, 0) for i, v in enumerate(rng.normal(size=(12, 2)))])
    with pytest.raises(ValueError):
        fit_index(flat, sizes=[1, 2], restarts=1)
    assert len(fit_index(flat, sizes=[1, 2], restarts=1, without_elbow=2).centers) == 2


def test_text_queries(spark, scratch):
    words = ["red cat", "red dog", "blue cat", "green bird", "green tree", "blue sky"]
    rows = [(f"t{i}", "texts", f"u/t{i}.jpg", w, f"t{i}") for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "id string, dataset string, url string, text string, img_name string")
    items = docs.withColumn("encd", encode_text(F.col("text"), lambda: HashingEncoder(16))).drop("text")
    path = scratch("index")
    index = SearchIndex.build(items, path, fit_index(items, k=1, restarts=1))
    queries = spark.createDataFrame([(1, "green  BIRD"), (2, ""), (3, None)], "query_id long, text string")
    found, refused = search_text(index, queries, lambda: HashingEncoder(16), 2)
    answers = found.collect()
    assert [r.query_id for r in answers] == [1]
    assert answers[0].names[0] == "t3" and answers[0].urls.startswith("u/t3.jpg\n")
    assert refused.count() == 2


def test_stream_equals_batch(spark, index, table, scratch):
    queries = table.select(F.col("id").alias("query_id"), "encd")
    arriving, out, state = scratch("arriving"), scratch("answers"), scratch("state")
    queries.where("query_id < 'i0100'").coalesce(1).write.parquet(arriving)

    def run():
        stream = spark.readStream.schema(queries.schema).parquet(arriving)
        answer_stream(stream, lambda batch: index.search(batch, 3), out, state, once=True).awaitTermination()

    run()
    queries.where("query_id >= 'i0100'").coalesce(1).write.mode("append").parquet(arriving)
    run()
    run()
    found = spark.read.parquet(out)
    assert found.select("batch").distinct().count() == 2
    batch = index.search(queries, 3)
    columns = batch.columns
    assert found.count() == 900
    assert found.select(columns).exceptAll(batch).count() == 0


def test_a_batch_run_again_overwrites_its_answers(spark, scratch):
    arriving, out = scratch("arriving"), scratch("answers")
    spark.range(10).write.parquet(arriving)
    for _ in range(2):
        stream = spark.readStream.schema("id long").parquet(arriving)
        answer_stream(stream, lambda batch: batch, out, scratch("state"), once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, index, table):
    stored = index.table.read()
    one = plan(stored.where("cluster_id = 2").select("id"))
    assert "PartitionFilters: [isnotnull(cluster_id" in one and "ReadSchema: struct<id:string>" in one
    ids = plan(stored.where(F.col("id").isin("a", "b")).select("id"))
    assert "PushedFilters: [In(id, [a,b])]" in ids
    single = plan(search.top_k_single(stored, [0.0] * 8, 5, 1))
    assert "TakeOrderedAndProject" in single and "Python" not in single and "Arrow" not in single
    batch = plan(index.search(table.select(F.col("id").alias("query_id"), "encd"), 5))
    assert "WindowGroupLimit" in batch and "PartitionFilters: [cluster_id" in batch and "encd" not in batch
    assert "Join" not in batch and "CartesianProduct" not in batch
    label = plan(stored.select(kmeans.nearest("reduced", index.model.centers)))
    assert "ReadSchema: struct<reduced:array<double>>" in label


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from vecshoal import session

    class Context:
        master = "yarn"
        applicationId = "app"

    class Settings:
        def __init__(self, named):
            self.named = named

        def get(self, name, default):
            assert name == "spark.checkpoint.dir"
            return self.named

    class Session:
        sparkContext = Context()

    cluster = Session()
    cluster.conf = Settings(None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(cluster)
    cluster.conf = Settings("hdfs://shared/x")
    assert session.scratch_root(cluster) == "hdfs://shared/x"
