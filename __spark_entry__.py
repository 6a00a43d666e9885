"""

The given tables stand in for the engine's own inputs. ``embeddings`` gives the items; its
``label`` serves as a cluster id wherever the answer should not depend on a random fit.
``documents`` and ``benchmark`` give item texts and query texts.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import partial, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.functions import vectors
from vecshoal.functions.encode import HashingEncoder
from vecshoal.operators import aggregates, kmeans, lookup, mixture, search, secondary
from vecshoal.operators.elbow import elbows
from vecshoal.operators.features import fit_features
from vecshoal.operators.joins import attach
from vecshoal.plans.coded import CodedIndex
from vecshoal.plans.index import SIZES, IndexModel, SearchIndex, fit_index
from vecshoal.plans.keyed import KeyedIndex, KeyedModel, fit_keys
from vecshoal.plans.text import search_text, with_vectors
from vecshoal.session import materialise, scratch_path
from vecshoal.sources import items as source
from vecshoal.sources.schema import CLUSTERED, ITEM
from vecshoal.sources.store import ItemTable, export_csv, ingest_csv, last_wins
from vecshoal.streaming.serve import answer_stream

# The operators for training data may be absent; all other queries do without them.
try:
    import corpus_pipeline
    from vecshoal.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "vecshoal.llm"):
        raise
    corpus = None

URL = "https://images.example/"
WIDTH = 64
TEXT_WIDTH = 64
FLAGS = ["A", "N", "R"]
LANGS = ["en", "de", "es", "fr"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Items with their label as the cluster."""
    return source.items_from_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", URL, label="label")


def plain(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).drop("cluster_id")


def as_queries(items: DataFrame) -> DataFrame:
    return items.withColumnRenamed("id", "query_id").drop("dataset", "url", "img_name")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# Reading, projecting, parsing


def scan_items(spark, sf):
    out = source.stored_layout(plain(spark, sf))
    return out.select("id", "dataset", "url", "img_name", vectors.width(F.col("encd")).alias("width"))


def first_items(spark, sf):
    return source.first_items(plain(spark, sf), 10).select("id", "img_name", "url")


def older_names(spark, sf):
    items = labelled(spark, sf)
    rows = aggregates.attach_centroid(items, aggregates.cluster_centroids(items))
    older = rows.withColumnsRenamed({new: old for old, new in source.OLDER_NAMES.items()})
    out = source.stored_layout(older)
    return out.select(
        "id",
        "cluster_id",
        "dataset",
        "img_name",
        vectors.width(F.col("encd")).alias("width"),
        F.round(vectors.element_sum(F.col("cluster_centroid")), 6).alias("centroid_sum"),
    )


def parse_text_vector(spark, sf):
    text = F.concat(F.lit("["), F.array_join(F.col("encd").cast("array<string>"), ", "), F.lit("]"))
    parsed = plain(spark, sf).select("id", vectors.parse_bracketed(text).alias("v"))
    total = F.round(vectors.element_sum(F.col("v")), 6)
    return parsed.select("id", vectors.width(F.col("v")).alias("width"), total.alias("total"))


def parse_json_vector(spark, sf):
    parsed = plain(spark, sf).select("id", vectors.parse_json(vectors.to_text(F.col("encd"))).alias("v"))
    head = vectors.first_elements(F.col("v"), 10)
    return parsed.select(
        "id",
        vectors.width(F.col("v")).alias("width"),
        F.round(vectors.element_sum(head), 6).alias("first_ten"),
    )


def wide_columns(spark, sf):
    return vectors.wide_columns(plain(spark, sf), "encd", WIDTH)


# Lookups


def lookup_id(spark, sf):
    return lookup.by_id(labelled(spark, sf), "images_000000000042").select("id", "img_name", "cluster_id")


def lookup_ids(spark, sf):
    ids = ["images_000000000001", "images_000000000019", "images_000000000063", "no'such_item"]
    return lookup.by_ids(labelled(spark, sf), ids).select("id", "img_name", "cluster_id")


def lookup_ids_semi(spark, sf):
    ids = table(spark, sf, "labels").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("img_name"))
    return lookup.by_id_table(labelled(spark, sf), source.with_keys(ids)).select("id", "cluster_id")


def lookup_cluster(spark, sf):
    return lookup.by_cluster(labelled(spark, sf), 3).select("id", "cluster_id")


def filter_predicate(spark, sf):
    both = lookup.matching(lookup.matching(labelled(spark, sf), {"dataset": "images", "cluster_id": 4}), "encd[0] > 0")
    return both.select("id", "cluster_id")


# Aggregates per dimension and per cluster


def cluster_sizes(spark, sf):
    return aggregates.cluster_sizes(labelled(spark, sf))


def dim_stats(spark, sf):
    return rounded(aggregates.dimension_stats(plain(spark, sf)), "mean", "std")


def cluster_centroids(spark, sf):
    means = aggregates.cluster_centroids(labelled(spark, sf))
    return rounded(means.select("cluster_id", "size", F.posexplode("centroid").alias("dim", "value")), "value")


def attach_centroid(spark, sf):
    items = labelled(spark, sf)
    paired = aggregates.attach_centroid(items, aggregates.cluster_centroids(items))
    away = F.sqrt(vectors.squared_distance(F.col("encd"), F.col("cluster_centroid")))
    return paired.select("id", "cluster_id", F.round(away, 6).alias("distance"))


def cluster_sse(spark, sf):
    return rounded(aggregates.own_mean_sse(labelled(spark, sf)), "sse")


def centroid_sse(spark, sf):
    items = labelled(spark, sf)
    return rounded(aggregates.centroid_sse(items, aggregates.cluster_centroids(items)), "sse")


def assign_fixed_centroids(spark, sf):
    items = labelled(spark, sf)
    return items.select("id", kmeans.nearest("encd", label_means(items)).alias("cluster_id"))


def label_means(items: DataFrame, vector: str = "encd", label: str = "cluster_id") -> np.ndarray:
    """One mean vector per label, in label order."""
    rows = items.select(F.col(label).alias("cluster_id"), vector)
    return np.array([r.centroid for r in aggregates.cluster_centroids(rows, vector).orderBy("cluster_id").collect()])


# Storing


def stored_items(spark, sf, rows: DataFrame) -> ItemTable:
    items = ItemTable(spark, scratch_path(spark, "items"), rows.schema)
    items.replace(rows)
    return items


def upsert_items(spark, sf):
    items = labelled(spark, sf).select("id", "dataset", "encd", "img_name", "cluster_id")
    stored = stored_items(spark, sf, items)
    marks = table(spark, sf, "labels").select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("img_name"),
        F.array_repeat(F.col("toxic").cast("double"), WIDTH).alias("encd"),
        (F.col("quality") + 100).alias("cluster_id"),
    )
    incoming = source.with_keys(marks)
    stored.upsert(incoming, ["encd"])
    stored.upsert(incoming, ["encd"])
    total = F.round(vectors.element_sum(F.col("encd")), 6)
    return stored.read().select("id", "dataset", "img_name", "cluster_id", total.alias("total"))


def upsert_last_wins(spark, sf):
    latest = last_wins(table(spark, sf, "events"), ["ts", "event_id"], key="user_id")
    return latest.select("user_id", "event_id", "event_type", "value")


def write_faulty_csv(spark, sf) -> str:
    """Every item twice: first the negated vector, later the vector itself, broken for some labels."""
    items = labelled(spark, sf)
    text = vectors.to_text(F.col("encd"))
    earlier = items.select("img_name", "url", vectors.to_text(F.transform("encd", lambda x: -x)).alias("encd"))
    label = F.col("cluster_id")
    broken = (
        F.when(label == 3, F.concat(F.lit("(not a vector "), "img_name"))
        .when(label == 5, vectors.to_text(F.slice("encd", 1, WIDTH - 1)))
        .when(label != 7, text)
    )
    path = scratch_path(spark, "csv")
    rows = earlier.unionByName(items.select("img_name", "url", broken.alias("encd")))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def ingest_items(spark, sf):
    items = ItemTable(spark, scratch_path(spark, "ingest"), ITEM, partition=None)
    ingest_csv(items, write_faulty_csv(spark, sf), WIDTH)
    return items.read().select("id", "dataset", "url", F.round(vectors.element_sum(F.col("encd")), 6).alias("total"))


def ingest_rejects(spark, sf):
    items = ItemTable(spark, scratch_path(spark, "ingest"), ITEM, partition=None)
    return ingest_csv(items, write_faulty_csv(spark, sf), WIDTH).select("id", "reason")


def append_items(spark, sf):
    rows = plain(spark, sf)
    items = ItemTable(spark, scratch_path(spark, "append"), ITEM, partition=None)
    items.replace(rows)
    items.append(source.with_keys(rows, "copies"))
    return items.read().groupBy("dataset").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"))


def truncate_count(spark, sf):
    items = stored_items(spark, sf, labelled(spark, sf))
    stored, removed = items.read().count(), items.truncate()
    counts = [(stored, removed, items.read().count())]
    return spark.createDataFrame(counts, "stored long, removed long, remaining long")


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv")
    items = plain(spark, sf)
    export_csv(items, path)
    back = source.read_csv_items(spark, path).select("id", F.col("encd").alias("back"))
    same = items.join(back, "id").select("id", (F.col("encd") == F.col("back")).alias("same"))
    return same.groupBy("same").agg(F.count("*").alias("rows"))


def partitioned_read(spark, sf):
    items = labelled(spark, sf)
    rows = aggregates.attach_centroid(items, aggregates.cluster_centroids(items))
    stored = ItemTable(spark, scratch_path(spark, "items"), CLUSTERED)
    stored.replace(rows)
    one = lookup.by_cluster(stored.read(), 3)
    return one.select("id", "cluster_id", vectors.width(F.col("cluster_centroid")).alias("centroid_width"))


# Search with given clusters


def topk_raw_single(spark, sf):
    items = labelled(spark, sf)
    probe = lookup.by_id(items, "images_000000000019").first()
    found = search.top_k_single(items, probe.encd, 20, probe.cluster_id)
    return rounded(found, "similarity")


def topk_raw_all_clusters(spark, sf):
    items = labelled(spark, sf)
    probe = lookup.by_id(items, "images_000000000019").first()
    return rounded(search.top_k_single(items, probe.encd, 20), "similarity")


def topk_raw_batch(spark, sf):
    items = labelled(spark, sf)
    return rounded(search.top_k(items, as_queries(items), 20), "similarity")


def topk_raw_dealt(spark, sf):
    """The same with queries too many to be sent to all tasks, in blocks smaller than a cluster."""
    items = labelled(spark, sf)
    found = search.top_k(items, as_queries(items), 20, query_bytes=1, block_items=30, block_queries=20)
    return rounded(found, "similarity")


def topk_urls(spark, sf):
    items = labelled(spark, sf)
    lists = search.result_lists(search.top_k(items, as_queries(items), 10))
    return lists.select("query_id", F.array_join("names", ",").alias("names"), "urls")


def query_rejects(spark, sf):
    lang = F.col("lang")
    text = F.when(lang == "de", "").when(lang == "es", " \t ").when(lang != "fr", F.col("text"))
    _, refused = search.split_queries(table(spark, sf, "documents").select("doc_id", text.alias("text")))
    return refused.select("doc_id", "reason")


def stream_search(spark, sf):
    items = labelled(spark, sf)
    keyed = as_queries(items).select("query_id", "cluster_id", "encd")
    _, arriving = materialise(keyed, "arriving")
    out, state = scratch_path(spark, "answers"), scratch_path(spark, "stream")
    stream = spark.readStream.schema(keyed.schema).parquet(arriving)
    answer_stream(stream, lambda batch: search.top_k(items, batch, 20), out, state, once=True).awaitTermination()
    found = spark.read.parquet(out).select("query_id", "rank", "id", "img_name", "url", "similarity")
    return rounded(found, "similarity")


# Features


def pca_variance_curve(spark, sf):
    return fit_features(plain(spark, sf)).variance_curve(spark)


def pca_component_count(spark, sf):
    model = fit_features(plain(spark, sf), share=0.95)
    curve = model.variance_curve(spark).where(F.col("component") == model.kept)
    return curve.select(F.col("component").alias("components"), "cumulative")


def pca_two_columns(spark, sf):
    """Ratios and running totals of two columns, whose spectrum has a closed form, and how many components hold 90 % of the variance."""
    points = table(spark, sf, "lineitem").select(F.array("l_quantity", "l_extendedprice").alias("v"))
    model = fit_features(points, "v", share=0.9)
    return rounded(model.variance_curve(spark).withColumn("kept", F.lit(model.kept)), "ratio", "cumulative")


def pca_spectrum_moments(spark, sf):
    """Sums of powers of the spectrum, which have closed forms in the correlations."""
    curve = fit_features(plain(spark, sf)).variance_curve(spark)
    powers = [F.round(F.sum(F.pow("ratio", F.lit(p))), 9).alias(f"power_{p}") for p in (1, 2, 3)]
    return curve.agg(F.max("component").cast("long").alias("components"), *powers)


def pca_spectrum_by_factors(spark, sf):
    """The same sums, with components from triangular factors."""
    curve = fit_features(plain(spark, sf), factors=True).variance_curve(spark)
    powers = [F.round(F.sum(F.pow("ratio", F.lit(p))), 9).alias(f"power_{p}") for p in (1, 2, 3)]
    return curve.agg(F.max("component").cast("long").alias("components"), *powers)


def pca_near_singular(spark, sf):
    """Prices beside prices plus a millionth of the quantity: the order of magnitude of the second component, below what products can show."""
    price = F.col("l_extendedprice").cast("double")
    rows = table(spark, sf, "lineitem").select(F.array(price, price + F.col("l_quantity").cast("double") * 1e-6).alias("encd"))
    curve = fit_features(rows, factors=True).variance_curve(spark).where("component = 2")
    return curve.select("component", F.round(F.log10("ratio"), 3).alias("magnitude"))


def pca_distances(spark, sf):
    """Distance of each item from the mean of all items, in the space of all components."""
    model = fit_features(plain(spark, sf), share=None, components=WIDTH)
    reduced = plain(spark, sf).select("id", model.project("encd").alias("reduced"))
    return reduced.select("id", F.round(vectors.norm(F.col("reduced")), 6).alias("length"))


def search_standardised(spark, sf):
    """With all components kept, similarities are those of the standardised vectors."""
    items = labelled(spark, sf)
    model = fit_features(items, share=None, components=WIDTH)
    rows = items.withColumn("reduced", model.project("encd"))
    queries = rows.select(F.col("id").alias("query_id"), "cluster_id", "reduced")
    return rounded(search.top_k(rows, queries, 20, "reduced"), "similarity")


# Clustering


def reduced_items(spark, sf, components: int | None = None) -> DataFrame:
    items = plain(spark, sf)
    model = fit_features(items, share=None if components else 0.95, components=components)
    return materialise(items.select("id", model.project("encd").alias("reduced")), "reduced")[0]


def lloyd_from_label_means(spark, sf):
    items = labelled(spark, sf)
    fit = kmeans.fit_from(items, label_means(items), "encd", max_iter=2)
    rows = [(i, int(n), float(c.sum()), fit.sse) for i, (n, c) in enumerate(zip(fit.sizes, fit.centers))]
    made = spark.createDataFrame(rows, "cluster_id int, size long, center_sum double, total_sse double")
    return rounded(made, "center_sum", "total_sse")


def best_sweep(spark, sf):
    return kmeans.best_fits(kmeans.fit_many(reduced_items(spark, sf), SIZES))


def sse_sweep(spark, sf):
    return kmeans.sweep_table(spark, best_sweep(spark, sf)).select("k", "sse")


def elbow(spark, sf):
    return elbows(kmeans.sweep_table(spark, best_sweep(spark, sf)))


def sweep_recomputed(spark, sf):
    """The reported sums of squares against labels and distances computed item by item."""
    points = reduced_items(spark, sf)
    best = kmeans.best_fits(kmeans.fit_many(points, SIZES))
    parts = []
    for (_, k), fit in sorted(best.items()):
        labelled_points = points.withColumn("cluster_id", kmeans.nearest("reduced", fit.centers))
        per_cluster = aggregates.centroid_sse(labelled_points, kmeans.centroid_table(spark, fit.centers), "reduced")
        agree = F.abs(F.sum("sse") - fit.sse) < 1e-6 * fit.sse + 1e-9
        clusters = F.count_if(F.col("size") > 0)
        parts.append(per_cluster.agg(F.lit(k).alias("k"), F.sum("size").alias("rows"), clusters.alias("clusters"), agree.alias("agree")))
    return reduce(DataFrame.unionByName, parts)


def sweep_of_one(spark, sf):
    """k = 1 has one answer: the squared distances to the mean."""
    fits = kmeans.fit_many(labelled(spark, sf), [1], "encd", group="cluster_id")
    out = kmeans.sweep_table(spark, kmeans.best_fits(fits), "cluster_id")
    return rounded(out, "sse")


def elbow_price_bins(spark, sf):
    """Elbow of the squared error of k equal bins of order prices, a curve per priority."""
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("curve"), F.col("o_totalprice").alias("v"))
    ends = orders.groupBy("curve").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    each = attach(orders, ends, "curve", spread="v").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(49), F.lit(3))))
    spot = F.floor(F.col("k") * ((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))))
    binned = each.withColumn("bin", F.least(F.col("k") - 1, spot))
    parts = binned.groupBy("curve", "k", "bin").agg(F.var_pop("v").alias("var"), F.count("*").alias("n"))
    curves = parts.groupBy("curve", "k").agg(F.sum(F.col("var") * F.col("n")).alias("sse"))
    return elbows(curves).select("curve", F.col("elbow").cast("long").alias("elbow"))


# Mixtures and secondary keys


def gmm_labels(spark, sf):
    points = reduced_items(spark, sf)
    model = mixture.fit_mixtures(points, [4])[0]
    return points.select("id", model.label("reduced").alias("gmm_cluster_id"))


def event_values(spark, sf) -> DataFrame:
    """Event values as vectors, with the component that each starts in: split at 50."""
    start = (F.col("value") > 50).cast("int").alias("side")
    return table(spark, sf, "events").select("event_id", F.array("value").alias("v"), start)


def gmm_label_rows(spark, sf):
    """Events of component 0, after three rounds of EM from a given split."""
    points = event_values(spark, sf)
    model = mixture.fit_mixtures(points, [2], "v", start="side", tol=0.0, max_iter=3)[0]
    labelled_points = points.select("event_id", model.label("v").alias("gmm_cluster_id"))
    return lookup.by_cluster(labelled_points, 0, "gmm_cluster_id")


def gmm_bic_aic(spark, sf):
    return mixture.criteria_table(spark, mixture.fit_mixtures(reduced_items(spark, sf), list(range(1, 11))))


def gmm_criteria_given(spark, sf):
    """Criteria of one and two components from given starts; the least of each tells the size to take."""
    points = event_values(spark, sf)
    one = mixture.fit_mixtures(points.withColumn("side", F.lit(0)), [1], "v", start="side", tol=0.0, max_iter=3)
    two = mixture.fit_mixtures(points, [2], "v", start="side", tol=0.0, max_iter=3)
    made = mixture.criteria_table(spark, one + two)
    return rounded(made, "log_likelihood", "bic", "aic", digits=4)


def gmm_event_values(spark, sf):
    """Three rounds of EM with two components on one column, from a split at 50."""
    model = mixture.fit_mixtures(event_values(spark, sf), [2], "v", start="side", tol=0.0, max_iter=3)[0]
    rows = [
        (i, float(model.weights[i]), float(model.means[i, 0]), float(model.covariances[i, 0, 0]), model.log_likelihood,
         float(model.bic), float(model.aic))
        for i in range(2)
    ]
    schema = "component int, weight double, mean double, variance double, log_likelihood double, bic double, aic double"
    made = spark.createDataFrame(rows, schema)
    return rounded(made, *[f.name for f in made.schema.fields[1:]], digits=5)


def gmm_line_items(spark, sf):
    """Two rounds of EM with three components on two columns, from a split by return flag."""
    start = (F.array_position(F.array(*[F.lit(flag) for flag in FLAGS]), F.col("l_returnflag")) - 1).alias("side")
    vector = F.array("l_quantity", F.col("l_extendedprice") / 1000).alias("v")
    key = F.xxhash64("l_orderkey", "l_linenumber").alias("line")
    points = table(spark, sf, "lineitem").select(key, vector, start)
    model = mixture.fit_mixtures(points, [3], "v", start="side", tol=0.0, max_iter=2)[0]
    rows = []
    for i in range(3):
        c = model.covariances[i]
        values = [model.weights[i], *model.means[i], c[0, 0], c[0, 1], c[1, 1], model.log_likelihood / model.rows]
        rows.append((i, *[float(v) for v in values]))
    names = ["weight", "mean_0", "mean_1", "cov_00", "cov_01", "cov_11", "mean_log_likelihood"]
    made = spark.createDataFrame(rows, "component int, " + ", ".join(f"{n} double" for n in names))
    return rounded(made, *names)


def secondary_given(spark, sf):
    """Secondary clusters for given groups and centres: labels modulo 3, and the means of the labels in each."""
    items = labelled(spark, sf)
    means = label_means(items)
    keys = secondary.SecondaryKeys(None, None, {g: means[g::3] for g in range(3)})
    grouped = items.withColumn("gmm_cluster_id", F.col("cluster_id") % 3)
    return keys.label(grouped, "gmm_cluster_id", "encd").select("id", "gmm_cluster_id", "secondary_cluster_id")


def sweep_given_starts(spark, sf, moves=2):
    """Two moves of every size inside every group, from given centres: sums of squares by priority of orders."""
    orders = table(spark, sf, "orders")
    code = F.substring("o_orderpriority", 1, 1).cast("int").alias("curve")
    points = orders.select(code, F.array(F.col("o_totalprice") / 1000).alias("v"))
    starts = {(g, k): np.array([[400.0 * (i + 0.5) / k] for i in range(k)]) for g in range(1, 6) for k in range(1, 14, 3)}
    fits = kmeans.fit_given(points, starts, "v", "curve", max_iter=moves)
    return rounded(kmeans.sweep_table(spark, kmeans.best_fits(fits)), "sse", digits=4)


def sweep_by_marks(spark, sf):
    """Eight moves: from the third on, most rows keep their centre by the triangle inequality."""
    return sweep_given_starts(spark, sf, moves=8)


def kmeans_fills_clusters(spark, sf):
    """Rows of few different values: as many clusters are filled as there are values for them, in every restart."""
    points = table(spark, sf, "lineitem").select(F.array("l_quantity", F.col("l_linenumber").cast("double")).alias("v"))
    fits = kmeans.fit_many(points, [20, 200], "v", restarts=3)
    rows = [(fit.k, fit.restart, int((fit.sizes > 0).sum()), int(fit.sizes.sum())) for fit in fits]
    return spark.createDataFrame(rows, "k int, restart int, filled long, rows long")


def secondary_key(spark, sf):
    points = reduced_items(spark, sf)
    model = mixture.fit_mixtures(points, [4])[0]
    grouped, _ = materialise(points.withColumn("gmm_cluster_id", model.label("reduced")), "grouped")
    keys = secondary.fit_secondary(grouped, "gmm_cluster_id", without_elbow=7)
    return keys.label(grouped, "gmm_cluster_id").select("id", "gmm_cluster_id", "secondary_cluster_id")


def secondary_complete(spark, sf):
    """Every item has both keys."""
    keyed = secondary_key(spark, sf)
    both = F.col("gmm_cluster_id").isNotNull() & F.col("secondary_cluster_id").isNotNull()
    return keyed.agg(F.count("*").alias("rows"), F.count_if(both).alias("keyed"))


def sub_sweep(spark, sf):
    """The sweep inside cluster 0 of a K-Means fit."""
    points = reduced_items(spark, sf)
    first = kmeans.best_fits(kmeans.fit_many(points, [4]))[0, 4]
    inside = points.withColumn("cluster_id", kmeans.nearest("reduced", first.centers)).where("cluster_id = 0")
    keys = secondary.fit_secondary(materialise(inside, "inside")[0], "cluster_id")
    return keys.sweep.join(keys.elbow, "cluster_id")


def evenly(groups, sizes=range(1, 14, 3)) -> dict[tuple[int, int], np.ndarray]:
    """Centres spread evenly from 0 to 400, for every group and size."""
    return {(g, k): np.array([[400.0 * (i + 0.5) / k] for i in range(k)]) for g in groups for k in sizes}


def order_prices(spark, sf) -> DataFrame:
    code = F.substring("o_orderpriority", 1, 1).cast("int").alias("curve")
    return table(spark, sf, "orders").select("o_orderkey", code, F.array(F.col("o_totalprice") / 1000).alias("v"))


def sub_sweep_given(spark, sf):
    """The sweep inside cluster 0 of a K-Means fit, and its elbow: all from given centres, two moves each."""
    points = order_prices(spark, sf)
    first = kmeans.fit_given(points, {(0, 2): np.array([[100.0], [300.0]])}, "v", max_iter=2)[0]
    inside = points.withColumn("cluster_id", kmeans.nearest("v", first.centers)).where("cluster_id = 0")
    keys = secondary.fit_secondary(inside, "cluster_id", vector="v", max_iter=2, starts=evenly([0]))
    out = keys.sweep.join(keys.elbow, "cluster_id").select("k", "sse", F.col("elbow").cast("int").alias("elbow"))
    return rounded(out, "sse", digits=4)


def secondary_fitted_given(spark, sf):
    """Sweep, elbow, fit and labels in every group at once, from given centres: rows and mean by group and label."""
    points = order_prices(spark, sf)
    keys = secondary.fit_secondary(points, "curve", vector="v", max_iter=2, without_elbow=7, starts=evenly(range(1, 6)))
    labelled_points = keys.label(points, "curve", "v")
    mean = F.round(F.avg(F.get("v", F.lit(0))), 4).alias("mean")
    return labelled_points.groupBy("curve", "secondary_cluster_id").agg(F.count("*").alias("rows"), mean)


def fit_index_given(spark, sf):
    """Scaler, components, sweep from given centres (the means of the first labels), elbow and labels: the cluster of every item."""
    items = labelled(spark, sf)
    means = label_means(items)
    model = fit_index(items, components=WIDTH, starts={k: means[:k] for k in range(1, 11)}, max_iter=2, without_elbow=4)
    return model.place(items.drop("cluster_id")).select("id", "cluster_id")


# The whole index


def built_index(spark, sf) -> SearchIndex:
    items = plain(spark, sf)
    model = fit_index(items, without_elbow=10)
    path = scratch_path(spark, "index")
    SearchIndex.build(items, path, model)
    return SearchIndex.open(spark, path)


def fit_index_items(spark, sf):
    return built_index(spark, sf).table.read().select("id", "cluster_id", "url")


def search_reduced(spark, sf):
    return built_index(spark, sf).search(as_queries(plain(spark, sf)), 20)


def index_finds_itself(spark, sf):
    """Every item as a query: itself comes first, with similarity 1."""
    found = search_reduced(spark, sf).where("rank = 1")
    hit = (F.col("id") == F.col("query_id")) & (F.round("similarity", 9) == 1)
    return found.agg(F.count("*").alias("queries"), F.count_if(hit).alias("hits"))


def index_keeps_clusters(spark, sf):
    """The cluster computed again from the loaded model is the stored one."""
    index = built_index(spark, sf)
    stored = index.table.read().select("id", "encd", F.col("cluster_id").alias("was"))
    same = index.model.place(stored).where(F.col("cluster_id") == F.col("was"))
    return same.agg(F.count("*").alias("same"))


def index_upsert(spark, sf):
    """Storing all items again changes neither the ids nor their number."""
    index = built_index(spark, sf)
    index.upsert(plain(spark, sf), None)
    return index.table.read().select("id", "dataset", "url", F.array_size("encd").alias("width"))


def given_index(spark, sf, kind=SearchIndex) -> SearchIndex:
    """A stored index whose answers do not depend on a random fit: all components, label means as centres."""
    items = labelled(spark, sf)
    features = fit_features(items, share=None, components=WIDTH)
    reduced = items.select("cluster_id", features.project("encd").alias("reduced"))
    means = aggregates.cluster_centroids(reduced, "reduced").orderBy("cluster_id").collect()
    model = IndexModel(features, np.array([r.centroid for r in means]), {})
    path = scratch_path(spark, "index")
    kind.build(items, path, model)
    return kind.open(spark, path)


def search_coded_given(spark, sf):
    """The answers of the index by way of short codes: those of all items as queries, whose candidates alone are scored by vectors."""
    return rounded(given_index(spark, sf, CodedIndex).search(as_queries(plain(spark, sf)), 20), "similarity")


def coded_bounds(spark, sf):
    """Similarity of every item that may be the nearest other one of a query in its cluster: how many of its bounds hold, by cluster."""
    index = given_index(spark, sf, CodedIndex)
    stored = index.table.read().select(F.col("id").alias("query_id"))
    asked = as_queries(plain(spark, sf)).join(stored, "query_id", "left_semi")
    # Pairs are scored and counted where they are made, as there are as many as the square of a cluster.
    counts = index.candidates(asked, 1_000_000, exact=True, within=0.1)
    return counts.groupBy("cluster_id").agg(F.sum("pairs").alias("pairs"), F.sum("held").alias("held"))


def search_given_index(spark, sf):
    """The whole online path for all items as queries: project, find the cluster, read it, rank."""
    return rounded(given_index(spark, sf).search(as_queries(plain(spark, sf)), 20), "similarity")


def index_centroids(spark, sf):
    """The stored centroid of every item: that of its cluster, told by its length."""
    stored = given_index(spark, sf).table.read()
    return stored.select("id", "cluster_id", F.round(vectors.norm(F.col("cluster_centroid")), 6).alias("centroid_length"))


def queries_refused(spark, sf):
    """Vector queries of which some are short, missing, without an id or of an id with two vectors: how many are refused, and why."""
    asked = as_queries(plain(spark, sf)).withColumn("n", F.substring("query_id", -3, 3).cast("int"))
    vector = F.when(F.col("n") % 10 == 1, F.slice("encd", 1, 3)).when(F.col("n") % 10 != 2, F.col("encd"))
    name = F.when(F.col("n") % 10 == 3, None).when(F.col("n") % 10 == 4, "twice").otherwise(F.col("query_id"))
    asked = asked.select(name.alias("query_id"), vector.alias("encd"))
    index = given_index(spark, sf)
    answered = index.search(asked, 1).agg(F.lit("answered").alias("reason"), F.countDistinct("query_id").alias("queries"))
    return index.refused(asked).groupBy("reason").agg(F.count("*").alias("queries")).unionByName(answered)


def build_sets_aside(spark, sf):
    """Rows without an id, and rows of one id without an order, are set aside when an index is built."""
    items = plain(spark, sf).withColumn("n", F.substring("id", -3, 3).cast("int"))
    name = F.when(F.col("n") % 10 == 3, None).when(F.col("n") % 10 == 4, "twice").otherwise(F.col("id"))
    given = given_index(spark, sf).model
    index = SearchIndex.build(items.withColumn("id", name).drop("n"), scratch_path(spark, "index"), given)
    kept = index.table.read().agg(F.lit("stored").alias("reason"), F.count("*").alias("rows"))
    return index.rejected().groupBy("reason").agg(F.count("*").alias("rows")).unionByName(kept)


def search_given_index_one(spark, sf):
    """The same for one vector."""
    probe = lookup.by_id(plain(spark, sf), "images_000000000019").first()
    return rounded(given_index(spark, sf).search_one(probe.encd, 20), "similarity")


def given_keyed_index(spark, sf) -> KeyedIndex:
    """A two-level index that does not depend on a random fit: round components about the means of the labels modulo 3, and the
    means of the labels of each as the centres inside."""
    items = labelled(spark, sf)
    features = fit_features(items, share=None, components=WIDTH)
    reduced = items.select("cluster_id", (F.col("cluster_id") % 3).alias("g"), features.project("encd").alias("reduced"))
    means = label_means(reduced, "reduced")
    given = mixture.Mixture(np.full(3, 1 / 3), label_means(reduced, "reduced", "g"), np.array([np.eye(WIDTH)] * 3))
    model = KeyedModel(IndexModel(features, means, {}), given, {g: means[g::3] for g in range(3)})
    path = scratch_path(spark, "keyed")
    KeyedIndex.build(plain(spark, sf), path, model)
    return KeyedIndex.open(spark, path)


def keyed_lists(spark, sf):
    """The lists of the two-level index: rows and lowest id of each pair of keys."""
    stored = given_keyed_index(spark, sf).table.read()
    return stored.groupBy("gmm_cluster_id", "secondary_cluster_id").agg(F.count("*").alias("rows"), F.min("id").alias("first"))


def search_keyed_given(spark, sf):
    """All items as queries, each of its nearest list alone."""
    return rounded(given_keyed_index(spark, sf).search(as_queries(plain(spark, sf)), 20), "similarity")


def search_keyed_two_lists(spark, sf):
    """The same over the two nearest lists of the group, ranked together."""
    return rounded(given_keyed_index(spark, sf).search(as_queries(plain(spark, sf)), 20, lists=2), "similarity")


def search_keyed_fitted(spark, sf):
    """The two-level index fitted, stored and loaded: every item asked finds itself first, whatever the fit."""
    items = plain(spark, sf)
    path = scratch_path(spark, "keyed")
    KeyedIndex.build(items, path, fit_keys(items, fit_index(items, k=4, restarts=2), sizes=[1, 4, 7, 10], without_elbow=4, restarts=2))
    found = KeyedIndex.open(spark, path).search(as_queries(items), 5).where("rank = 1")
    hit = (F.col("id") == F.col("query_id")) & (F.round("similarity", 9) == 1)
    return found.agg(F.count("*").alias("queries"), F.count_if(hit).alias("hits"))


# Text


# Built from a class of the package, so that tasks need not import this file.
encoder = partial(HashingEncoder, TEXT_WIDTH)


def document_items(spark, sf) -> DataFrame:
    docs = with_vectors(table(spark, sf, "documents"), encoder, "doc_id", vector="embedding")
    code = F.array_position(F.array(*[F.lit(lang) for lang in LANGS]), F.col("lang")) - 1
    rows = docs.withColumn("code", code)
    return source.items_from_vectors(rows, "doc_id", "embedding", URL, dataset="texts", label="code")


def encode_documents(spark, sf):
    items = document_items(spark, sf)
    weighted = vectors.dot(F.col("encd"), vectors.literal(range(1, TEXT_WIDTH + 1)))
    return items.select(
        "id",
        F.round(weighted, 6).alias("weighted"),
        F.round(vectors.element_sum(F.col("encd")), 6).alias("total"),
        F.round(vectors.norm(F.col("encd")), 6).alias("length"),
    )


def search_text_by_language(spark, sf):
    """Benchmark texts against documents, the languages being the clusters."""
    items, _ = materialise(document_items(spark, sf), "texts")
    means = label_means(items)
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    encoded = with_vectors(texts, encoder, "query_id")
    placed = encoded.withColumn("cluster_id", kmeans.nearest("encd", means))
    return rounded(search.top_k(items, placed, 10), "similarity").select("query_id", "rank", "id", "similarity")


def search_text_index(spark, sf):
    items, _ = materialise(document_items(spark, sf).drop("cluster_id"), "texts")
    path = scratch_path(spark, "index")
    index = SearchIndex.build(items, path, fit_index(items, k=8))
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    answers, _ = search_text(index, texts, encoder, 10)
    return answers.select("query_id", "urls")


def given_text_index(spark, sf) -> SearchIndex:
    """Documents in an index that does not depend on a random fit: all components, the means of the languages as centres."""
    items, _ = materialise(document_items(spark, sf), "texts")
    features = fit_features(items, share=None, components=TEXT_WIDTH)
    reduced = items.select("cluster_id", features.project("encd").alias("reduced"))
    means = aggregates.cluster_centroids(reduced, "reduced").orderBy("cluster_id").collect()
    model = IndexModel(features, np.array([r.centroid for r in means]), {})
    return SearchIndex.build(items.drop("cluster_id"), scratch_path(spark, "index"), model)


def text_queries(spark, sf) -> DataFrame:
    """Benchmark texts, every fourth of them blank."""
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return texts.withColumn("text", F.when(F.col("query_id") % 4 != 3, F.col("text")).otherwise(" "))


def with_refused(answers: DataFrame, refused: DataFrame) -> DataFrame:
    """Answers, and a row with a negative count for each reason of refusal."""
    told = refused.groupBy("reason").agg(F.count("*").alias("n")).select((-F.col("n")).alias("query_id"), F.col("reason").alias("urls"))
    return answers.select("query_id", "urls").unionByName(told)


def search_text_given(spark, sf):
    """The whole text path: check, encode, place, search, give addresses."""
    return with_refused(*search_text(given_text_index(spark, sf), text_queries(spark, sf), encoder, 10))


def stream_text(spark, sf):
    """The same for a stream of texts, answers and refused queries each in a folder of their own."""
    index = given_text_index(spark, sf)
    asked = text_queries(spark, sf)
    _, arriving = materialise(asked.repartition(3), "arriving")
    out, others, state = (scratch_path(spark, label) for label in ("answers", "refused", "stream"))
    stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    answer = lambda batch: search_text(index, batch, encoder, 10)
    answer_stream(stream, answer, out, state, once=True, refused=others).awaitTermination()
    return with_refused(spark.read.parquet(out), spark.read.parquet(others))


def entry(spark: SparkSession) -> DataFrame:
    """Fit an index on the items, then find the 20 items most similar to one of them."""
    sf = "/root/testdata/sf0.001"
    items = plain(spark, sf)
    index = SearchIndex.build(items, scratch_path(spark, "index"), fit_index(items, k=10))
    return index.search(as_queries(lookup.by_id(items, "images_000000000001")), 20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [
        scan_items, first_items, older_names, parse_text_vector, parse_json_vector, wide_columns,
        lookup_id, lookup_ids, lookup_ids_semi, lookup_cluster, filter_predicate,
        cluster_sizes, dim_stats, cluster_centroids, attach_centroid, cluster_sse, centroid_sse, assign_fixed_centroids,
        upsert_items, upsert_last_wins, ingest_items, ingest_rejects, append_items, truncate_count, csv_round_trip,
        partitioned_read,
        topk_raw_single, topk_raw_all_clusters, topk_raw_batch, topk_raw_dealt, topk_urls, query_rejects, stream_search,
        pca_variance_curve, pca_component_count, pca_two_columns, pca_spectrum_moments, pca_spectrum_by_factors, pca_near_singular, pca_distances, search_standardised,
        lloyd_from_label_means, sse_sweep, elbow, sweep_recomputed, sweep_of_one, elbow_price_bins,
        gmm_labels, gmm_label_rows, gmm_bic_aic, gmm_criteria_given, gmm_event_values, gmm_line_items, secondary_key, secondary_given, secondary_complete, sub_sweep, sub_sweep_given, secondary_fitted_given, sweep_given_starts, sweep_by_marks, kmeans_fills_clusters,
        fit_index_items, fit_index_given, search_reduced, index_finds_itself, index_keeps_clusters, index_upsert,
        search_given_index, search_given_index_one, index_centroids, queries_refused, build_sets_aside,
        search_coded_given, coded_bounds, keyed_lists, search_keyed_given, search_keyed_two_lists, search_keyed_fitted,
        encode_documents, search_text_by_language, search_text_index, search_text_given, stream_text,
    ]
    found = {query.__name__: query for query in made}
    if corpus is not None:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# SQL

NAME = "lpad(vec_id::VARCHAR, 12, '0')"
ITEMS = f"""items AS (
  SELECT 'images_' || {NAME} AS id, 'images' AS dataset, '{URL}' || {NAME} || '.jpg' AS url,
         embedding::DOUBLE[] AS encd, {NAME} AS img_name, label AS cluster_id
  FROM embeddings)"""
CELLS = """cells AS (
  SELECT id, cluster_id, unnest(encd) AS x, (generate_subscripts(encd, 1) - 1)::INT AS dim FROM items)"""
MEANS = """means AS (SELECT cluster_id, dim, avg(x) AS m, count(*) AS n FROM cells GROUP BY cluster_id, dim)"""
SSE = f"""WITH {ITEMS}, {CELLS}, {MEANS}
SELECT cluster_id, count(DISTINCT id) AS size, round(sum((x - m) * (x - m)), 6) AS sse
FROM cells JOIN means USING (cluster_id, dim) GROUP BY cluster_id"""


def nearest_sql(points: str, centers: str) -> str:
    """``(id, cluster_id, square)``: the nearest centre of every point, by cells of both."""
    return f"""(SELECT id, arg_min(cluster_id, (square, cluster_id)) AS cluster_id, min(square) AS square FROM (
      SELECT p.id, c.cluster_id, sum((p.x - c.m) * (p.x - c.m)) AS square
      FROM {points} p JOIN {centers} c USING (dim) GROUP BY p.id, c.cluster_id) GROUP BY id)"""


def pairs_sql(items: str, queries: str, k: int, vector: str = "encd") -> str:
    """Ranked items of each query's cluster; a zero vector, for which DuckDB gives NaN, counts as 0."""
    similarity = f"round(coalesce(nullif(list_cosine_similarity(q.{vector}, i.{vector}), 'nan'::DOUBLE), 0.0), 12)"
    return f"""SELECT q.query_id, (row_number() OVER (PARTITION BY q.query_id ORDER BY {similarity} DESC, i.id))::INT AS rank,
        i.id, i.img_name, i.url, round({similarity}, 6) AS similarity
      FROM {queries} q JOIN {items} i USING (cluster_id) QUALIFY rank <= {k}"""


MOMENTS = f"""WITH {ITEMS}, {CELLS},
    c AS (SELECT a.dim AS i, b.dim AS j, corr(a.x, b.x) AS r FROM cells a JOIN cells b USING (id) GROUP BY a.dim, b.dim),
    sq AS (SELECT a.i, b.j, sum(a.r * b.r) AS r2 FROM c a JOIN c b ON a.j = b.i GROUP BY a.i, b.j),
    d AS (SELECT count(DISTINCT i)::DOUBLE AS d FROM c)
    SELECT any_value(d)::BIGINT AS components, 1.0::DOUBLE AS power_1,
      round(sum(r * r) / any_value(d) ** 2, 9) AS power_2, round(sum(r * r2) / any_value(d) ** 3, 9) AS power_3
    FROM c JOIN sq ON c.i = sq.j AND c.j = sq.i, d"""
BATCH = f"WITH {ITEMS}, q AS (SELECT id AS query_id, cluster_id, encd FROM items) {pairs_sql('items', 'q', 20)}"


def em_steps(side: str = "(value > 50)::INT") -> list[str]:
    """Hard split, three rounds of EM, and the likelihood of the result."""
    steps = [f"p AS (SELECT event_id, value AS x, {side} AS side FROM events)", "n AS (SELECT count(*) AS n FROM p)"]
    steps.append(
        """m0 AS (SELECT side AS c, count(*) / any_value(n) AS w, avg(x) AS mu, var_pop(x) + 1e-6 AS v
        FROM p, n GROUP BY side)"""
    )
    for i in range(4):
        steps.append(
            f"""j{i} AS (SELECT event_id, x, c, ln(w) - 0.5 * ln(2 * pi() * v) - 0.5 * (x - mu) * (x - mu) / v AS lp
            FROM p, m{i})"""
        )
        steps.append(f"l{i} AS (SELECT event_id, ln(sum(exp(lp))) AS ll FROM j{i} GROUP BY event_id)")
        if i < 3:
            steps.append(f"r{i} AS (SELECT c, x, exp(lp - ll) AS r FROM j{i} JOIN l{i} USING (event_id))")
            steps.append(f"u{i} AS (SELECT c, sum(r) AS nk, sum(r * x) / sum(r) AS mu FROM r{i} GROUP BY c)")
            steps.append(
                f"""m{i + 1} AS (SELECT c, any_value(nk) / any_value(n) AS w, any_value(mu) AS mu,
                sum(r * (x - mu) * (x - mu)) / any_value(nk) + 1e-6 AS v FROM r{i} JOIN u{i} USING (c), n GROUP BY c)"""
            )
    return steps


def em_sql() -> str:
    return f"""WITH {', '.join(em_steps())}, total AS (SELECT sum(ll) AS ll FROM l3)
    SELECT c AS component, round(w, 5) AS weight, round(mu, 5) AS mean, round(v, 5) AS variance,
      round(ll, 5) AS log_likelihood, round(5 * ln(n) - 2 * ll, 5) AS bic, round(10 - 2 * ll, 5) AS aic
    FROM m3, total, n"""


def criteria_sql(components: int, side: str) -> str:
    """Likelihood and criteria of one column with so many components: weights, means and variances count."""
    free = 3 * components - 1
    return f"""(WITH {', '.join(em_steps(side))} SELECT {components} AS n_components, round(sum(ll), 4) AS log_likelihood,
      round({free} * ln(any_value(n)) - 2 * sum(ll), 4) AS bic, round({2 * free} - 2 * sum(ll), 4) AS aic FROM l3, n)"""


def sweep_sql(moves: int = 2) -> str:
    """Lloyd's moves for every curve and size from evenly spaced centres, and the sums of squares."""
    steps = ["""p AS (SELECT row_number() OVER () AS row, left(o_orderpriority, 1)::INT AS curve, o_totalprice / 1000 AS x FROM orders)""",
        """c0 AS (SELECT curve, k, i, 400.0::DOUBLE * (i + 0.5) / k AS c FROM (SELECT DISTINCT curve FROM p),
          (SELECT k, unnest(range(k)) AS i FROM (SELECT unnest(range(1, 14, 3)) AS k)))"""]
    for n in range(moves + 1):
        steps.append(f"""a{n} AS (SELECT row, curve, k, any_value(x) AS x, arg_min(i, ((x - c) ** 2, i)) AS i, min((x - c) ** 2) AS square
          FROM p JOIN c{n} USING (curve) GROUP BY row, curve, k)""")
        steps.append(f"""c{n + 1} AS (SELECT curve, k, i, coalesce(m, c) AS c FROM c{n}
          LEFT JOIN (SELECT curve, k, i, avg(x) AS m FROM a{n} GROUP BY curve, k, i) USING (curve, k, i))""")
    return f"WITH {', '.join(steps)} SELECT curve, k::INT AS k, round(sum(square), 4) AS sse FROM a{moves} GROUP BY curve, k"


def moves_sql(name: str, points: str, starts: str, moves: int = 2) -> list[str]:
    """Lloyd's moves over ``points`` of ``(row, curve, x)`` from ``starts`` of ``(curve, k, i, c)``: steps that end in the labels
    ``<name>_a<moves>`` and the centres ``<name>_c<moves>``."""
    steps = [f"{name}_c0 AS (SELECT * FROM {starts})"]
    for n in range(moves + 1):
        steps.append(f"""{name}_a{n} AS (SELECT row, curve, k, any_value(x) AS x, arg_min(i, ((x - c) ** 2, i)) AS i, min((x - c) ** 2) AS square
          FROM {points} JOIN {name}_c{n} USING (curve) GROUP BY row, curve, k)""")
        steps.append(f"""{name}_c{n + 1} AS (SELECT curve, k, i, coalesce(m, c) AS c FROM {name}_c{n}
          LEFT JOIN (SELECT curve, k, i, avg(x) AS m FROM {name}_a{n} GROUP BY curve, k, i) USING (curve, k, i))""")
    return steps


PRICES = "SELECT o_orderkey AS row, left(o_orderpriority, 1)::INT AS curve, o_totalprice / 1000 AS x FROM orders"


def evenly_sql(points: str) -> str:
    return f"""(SELECT curve, k, i, 400.0::DOUBLE * (i + 0.5) / k AS c FROM (SELECT DISTINCT curve FROM {points}),
      (SELECT k, unnest(range(k)) AS i FROM (SELECT unnest(range(1, 14, 3)) AS k)))"""


def sub_sweep_sql() -> str:
    steps = [f"p AS (SELECT row, 0 AS curve, x FROM ({PRICES}))"]
    steps += moves_sql("f", "p", "(SELECT 0 AS curve, 2 AS k, unnest([0, 1]) AS i, unnest([100.0, 300.0]::DOUBLE[]) AS c)")
    steps += ["o AS (SELECT row, curve, x FROM f_a2 WHERE i = 0)", *moves_sql("g", "o", evenly_sql("o"))]
    steps.append("y AS (SELECT curve, k AS x, sum(square) AS y FROM g_a2 GROUP BY curve, k)")
    return f"WITH {', '.join(steps)}, e AS (WITH {elbow_sql('y')}) SELECT x::INT AS k, round(y, 4) AS sse, elbow::INT AS elbow FROM y JOIN e USING (curve)"


def secondary_fitted_sql() -> str:
    steps = [f"p AS ({PRICES})", *moves_sql("g", "p", evenly_sql("p"))]
    steps.append("y AS (SELECT curve, k AS x, sum(square) AS y FROM g_a2 GROUP BY curve, k)")
    return f"""WITH {', '.join(steps)}, e AS (WITH {elbow_sql('y')})
      SELECT curve, i::INT AS secondary_cluster_id, count(*) AS rows, round(avg(x), 4) AS mean FROM g_a2 JOIN e USING (curve)
      WHERE k = coalesce(elbow, 7) GROUP BY curve, i"""


def fit_index_sql(moves: int = 2) -> str:
    """Lloyd's moves of every size over the standardised items, the elbow of the sums of squares, and the labels of its fit."""
    steps = [ITEMS, CELLS, "s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM cells GROUP BY dim)",
        "zc AS (SELECT id, cluster_id, dim, (x - m) / sd AS x FROM cells JOIN s USING (dim))",
        """c0 AS (SELECT k, cluster_id AS i, dim, m FROM (SELECT cluster_id, dim, avg(x) AS m FROM zc GROUP BY cluster_id, dim),
          (SELECT unnest(range(1, 11)) AS k) WHERE cluster_id < k)"""]  # fmt: skip
    for n in range(moves + 1):
        steps.append(f"""a{n} AS (SELECT id, k, arg_min(i, (square, i)) AS i, min(square) AS square FROM
          (SELECT id, k, i, sum((x - m) ** 2) AS square FROM zc JOIN c{n} USING (dim) GROUP BY id, k, i) GROUP BY id, k)""")
        steps.append(f"""c{n + 1} AS (SELECT k, i, dim, coalesce(b.m, c.m) AS m FROM c{n} c
          LEFT JOIN (SELECT k, i, dim, avg(x) AS m FROM a{n} JOIN zc USING (id) GROUP BY k, i, dim) b USING (k, i, dim))""")
    steps.append(f"y AS (SELECT 0 AS curve, k AS x, sum(square) AS y FROM a{moves} GROUP BY k)")
    return f"""WITH {', '.join(steps)}, e AS (WITH {elbow_sql('y')})
      SELECT id, i::INT AS cluster_id FROM a{moves}, e WHERE k = coalesce(elbow, 4)"""


def plane_em_sql(rounds: int = 2) -> str:
    """The same for two columns and three components, the 2 x 2 covariance inverted by hand."""
    steps = [f"""p AS (SELECT row_number() OVER () AS row, l_quantity AS x, l_extendedprice / 1000 AS y,
        list_position({FLAGS}, l_returnflag) - 1 AS side FROM lineitem)""",
        "r0 AS (SELECT row, x, y, side AS c, 1.0::DOUBLE AS r FROM p)"]
    for i in range(rounds + 1):
        steps.append(f"u{i} AS (SELECT c, sum(r) AS nk, sum(r * x) / sum(r) AS mx, sum(r * y) / sum(r) AS my FROM r{i} GROUP BY c)")
        steps.append(f"""m{i} AS (SELECT c, any_value(nk) / (SELECT count(*) FROM p) AS w, any_value(mx) AS mx, any_value(my) AS my,
            sum(r * (x - mx) * (x - mx)) / any_value(nk) + 1e-6 AS a, sum(r * (x - mx) * (y - my)) / any_value(nk) AS b,
            sum(r * (y - my) * (y - my)) / any_value(nk) + 1e-6 AS d FROM r{i} JOIN u{i} USING (c) GROUP BY c)""")
        steps.append(f"""j{i} AS (SELECT row, x, y, c, ln(w) - ln(2 * pi()) - 0.5 * ln(a * d - b * b)
            - 0.5 * (d * (x - mx) ** 2 - 2 * b * (x - mx) * (y - my) + a * (y - my) ** 2) / (a * d - b * b) AS lp
            FROM p, m{i})""")
        steps.append(f"l{i} AS (SELECT row, ln(sum(exp(lp))) AS ll FROM j{i} GROUP BY row)")
        steps.append(f"r{i + 1} AS (SELECT row, x, y, c, exp(lp - ll) AS r FROM j{i} JOIN l{i} USING (row))")
    return f"""WITH {', '.join(steps)} SELECT c::INT AS component, round(w, 6) AS weight, round(mx, 6) AS mean_0,
        round(my, 6) AS mean_1, round(a, 6) AS cov_00, round(b, 6) AS cov_01, round(d, 6) AS cov_11,
        (SELECT round(avg(ll), 6) FROM l{rounds}) AS mean_log_likelihood FROM m{rounds}"""


def encoded_sql(source_sql: str, key: str) -> str:
    """Hashed, signed, unit-length token counts of ``text`` as ``(key, encd)``."""
    return f"""(
      WITH tokens AS (SELECT {key} AS key, unnest(string_split_regex(lower(text), '[ \\t\\n\\r\\f\\v]+')) AS token FROM {source_sql}),
      hashed AS (SELECT key, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM tokens WHERE token <> ''),
      counts AS (SELECT key, (h >> 1) % {TEXT_WIDTH} AS dim, sum(1 - 2 * (h & 1))::DOUBLE AS x FROM hashed GROUP BY ALL),
      grid AS (SELECT key, dim FROM (SELECT DISTINCT key FROM tokens), (SELECT unnest(range({TEXT_WIDTH})) AS dim)),
      dense AS (SELECT key, dim, coalesce(x, 0.0) AS x FROM grid LEFT JOIN counts USING (key, dim)),
      sized AS (SELECT key, CASE WHEN sum(x * x) = 0 THEN 1.0 ELSE sqrt(sum(x * x)) END AS len FROM dense GROUP BY key)
      SELECT key, list(x / len ORDER BY dim) AS encd FROM dense JOIN sized USING (key) GROUP BY key)"""


TEXTS = f"""items AS (
  SELECT 'texts_' || lpad(doc_id::VARCHAR, 12, '0') AS id, '' AS img_name, '' AS url, encd,
         list_position({LANGS}, lang) - 1 AS cluster_id
  FROM documents JOIN {encoded_sql('documents', 'doc_id')} e ON e.key = doc_id)"""


GIVEN = f"""{ITEMS}, {CELLS},
  s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM cells GROUP BY dim),
  zc AS (SELECT id, cluster_id, dim, (x - m) / sd AS x FROM cells JOIN s USING (dim)),
  zm AS (SELECT cluster_id, dim, avg(x) AS m FROM zc GROUP BY cluster_id, dim),
  i AS (SELECT items.* EXCLUDE (cluster_id), a.cluster_id, z.std FROM items
        JOIN {nearest_sql('zc', 'zm')} a USING (id)
        JOIN (SELECT id, list(x ORDER BY dim) AS std FROM zc GROUP BY id) z USING (id)),
  q AS (SELECT id AS query_id, cluster_id, std FROM i)"""


def keyed_sql(lists: int) -> str:
    """Items ``i`` by list, and queries ``q`` of their ``lists`` nearest lists; a list is ten times the group and the number inside."""
    return f"""{ITEMS}, {CELLS},
  s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM cells GROUP BY dim),
  zc AS (SELECT id, cluster_id, dim, (x - m) / sd AS x FROM cells JOIN s USING (dim)),
  zm AS (SELECT cluster_id, dim, avg(x) AS m FROM zc GROUP BY cluster_id, dim),
  gm AS (SELECT cluster_id % 3 AS cluster_id, dim, avg(x) AS m FROM zc GROUP BY cluster_id % 3, dim),
  g AS {nearest_sql('zc', 'gm')},
  d AS (SELECT p.id, g.cluster_id AS gmm, m.cluster_id // 3 AS inside, sum((p.x - m.m) ** 2) AS square
    FROM zc p JOIN g USING (id) JOIN zm m ON m.dim = p.dim AND m.cluster_id % 3 = g.cluster_id GROUP BY ALL),
  l AS (SELECT id, gmm, inside, 10 * gmm + inside AS cluster_id, row_number() OVER (PARTITION BY id ORDER BY square, inside) AS near FROM d),
  i AS (SELECT items.* EXCLUDE (cluster_id), gmm, inside, l.cluster_id, z.std FROM items JOIN l USING (id)
    JOIN (SELECT id, list(x ORDER BY dim) AS std FROM zc GROUP BY id) z USING (id) WHERE near = 1),
  q AS (SELECT id AS query_id, l.cluster_id, std FROM i JOIN l USING (id) WHERE l.near <= {lists})"""


def elbow_sql(curves: str) -> str:
    """The windows of the elbow in SQL; ``curves`` holds ``(curve, x, y)``."""
    return f"""u AS (
      SELECT curve, x, (x - min(x) OVER c) / (max(x) OVER c - min(x) OVER c)::DOUBLE AS xs,
        1 - (y - min(y) OVER c) / (max(y) OVER c - min(y) OVER c) - (x - min(x) OVER c) / (max(x) OVER c - min(x) OVER c)::DOUBLE AS d,
        count(*) OVER c AS n
      FROM {curves} WINDOW c AS (PARTITION BY curve)),
    s AS (SELECT *, lag(d) OVER w AS before, lead(d) OVER w AS after FROM u WINDOW w AS (PARTITION BY curve ORDER BY x)),
    t AS (SELECT *, coalesce(d >= before, true) AND coalesce(d >= after, true) AS top,
        coalesce(d <= before, true) AND coalesce(d <= after, true) AS bottom FROM s),
    g AS (SELECT *, last_value(CASE WHEN top THEN x END IGNORE NULLS) OVER w AS top_x,
        last_value(CASE WHEN bottom THEN 0.0 WHEN top THEN d - 1.0 / (n - 1) END IGNORE NULLS) OVER w AS level
      FROM t WINDOW w AS (PARTITION BY curve ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT curve, arg_min(top_x, x) FILTER (WHERE n >= 3 AND top_x IS NOT NULL AND after < level) AS elbow
    FROM g GROUP BY curve"""


def oracle_sql() -> dict[str, str]:
    ids = "('images_000000000001', 'images_000000000019', 'images_000000000063', 'no''such_item')"
    single = f"""WITH {ITEMS}, q AS (SELECT id AS query_id, cluster_id, encd FROM items WHERE id = 'images_000000000019'),
      r AS (%s) SELECT rank, id, img_name, url, similarity FROM r"""
    found = {
        "scan_items": f"WITH {ITEMS} SELECT id, dataset, url, img_name, len(encd)::INT AS width FROM items",
        "first_items": f"WITH {ITEMS} SELECT id, img_name, url FROM items ORDER BY id LIMIT 10",
        "older_names": f"""WITH {ITEMS}, {CELLS}, {MEANS},
            sums AS (SELECT cluster_id, round(sum(m), 6) AS centroid_sum FROM means GROUP BY cluster_id)
            SELECT id, cluster_id, dataset, img_name, len(encd)::INT AS width, centroid_sum
            FROM items JOIN sums USING (cluster_id)""",
        "parse_text_vector": f"""WITH {ITEMS}
            SELECT id, len(encd)::INT AS width, round(list_sum(encd), 6) AS total FROM items""",
        "parse_json_vector": f"""WITH {ITEMS}
            SELECT id, len(encd)::INT AS width, round(list_sum(encd[1:10]), 6) AS first_ten FROM items""",
        "wide_columns": f"WITH {ITEMS} SELECT id, {', '.join(f'encd[{i + 1}] AS encd_{i}' for i in range(WIDTH))} FROM items",
        "lookup_id": f"WITH {ITEMS} SELECT id, img_name, cluster_id FROM items WHERE id = 'images_000000000042'",
        "lookup_ids": f"WITH {ITEMS} SELECT id, img_name, cluster_id FROM items WHERE id IN {ids}",
        "lookup_ids_semi": f"""WITH {ITEMS} SELECT id, cluster_id FROM items
            WHERE id IN (SELECT 'images_' || lpad(doc_id::VARCHAR, 12, '0') FROM labels)""",
        "lookup_cluster": f"WITH {ITEMS} SELECT id, cluster_id FROM items WHERE cluster_id = 3",
        "filter_predicate": f"WITH {ITEMS} SELECT id, cluster_id FROM items WHERE cluster_id = 4 AND encd[1] > 0",
        "cluster_sizes": "SELECT label AS cluster_id, count(*) AS size FROM embeddings GROUP BY label",
        "dim_stats": f"""WITH {ITEMS}, {CELLS}
            SELECT dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM cells GROUP BY dim""",
        "cluster_centroids": f"""WITH {ITEMS}, {CELLS}, {MEANS}
            SELECT cluster_id, n AS size, dim, round(m, 6) AS value FROM means""",
        "attach_centroid": f"""WITH {ITEMS}, {CELLS}, {MEANS}
            SELECT id, cluster_id, round(sqrt(sum((x - m) * (x - m))), 6) AS distance
            FROM cells JOIN means USING (cluster_id, dim) GROUP BY id, cluster_id""",
        "cluster_sse": SSE,
        "centroid_sse": SSE,
        "assign_fixed_centroids": f"""WITH {ITEMS}, {CELLS}, {MEANS}
            SELECT id, cluster_id FROM {nearest_sql('cells', 'means')}""",
        "upsert_items": f"""WITH {ITEMS}, marks AS (SELECT lpad(doc_id::VARCHAR, 12, '0') AS img_name, quality, toxic FROM labels)
            SELECT id, dataset, img_name, cluster_id, round(list_sum(encd), 6) AS total FROM items
            WHERE img_name NOT IN (SELECT img_name FROM marks)
            UNION ALL
            SELECT 'images_' || img_name, 'images', img_name, quality + 100, toxic * {WIDTH}::DOUBLE FROM marks""",
        "upsert_last_wins": """SELECT user_id, event_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "ingest_items": f"""WITH {ITEMS} SELECT id, dataset, url,
            round(CASE WHEN cluster_id IN (3, 5, 7) THEN -list_sum(encd) ELSE list_sum(encd) END, 6) AS total FROM items""",
        "ingest_rejects": f"""WITH {ITEMS} SELECT id, CASE cluster_id WHEN 3 THEN 'unreadable vector'
            WHEN 5 THEN 'wrong width' ELSE 'missing vector' END AS reason FROM items WHERE cluster_id IN (3, 5, 7)""",
        "append_items": """SELECT unnest(['images', 'copies']) AS dataset, count(*) AS rows, count(DISTINCT vec_id) AS ids
            FROM embeddings""",
        "truncate_count": "SELECT count(*) AS stored, 0::BIGINT AS remaining, count(*) AS removed FROM embeddings",
        "csv_round_trip": "SELECT true AS same, count(*) AS rows FROM embeddings",
        "partitioned_read": f"WITH {ITEMS} SELECT id, cluster_id, {WIDTH} AS centroid_width FROM items WHERE cluster_id = 3",
        "topk_raw_single": single % pairs_sql("items", "q", 20),
        "topk_raw_all_clusters": single % pairs_sql("(SELECT * REPLACE (0 AS cluster_id) FROM items)",
                                                    "(SELECT * REPLACE (0 AS cluster_id) FROM q)", 20),
        "topk_raw_batch": BATCH,
        "topk_raw_dealt": BATCH,
        "stream_search": BATCH,
        "topk_urls": f"""WITH {ITEMS}, q AS (SELECT id AS query_id, cluster_id, encd FROM items),
            r AS ({pairs_sql('items', 'q', 10)})
            SELECT query_id, string_agg(img_name, ',' ORDER BY rank) AS names,
              string_agg(url, chr(10) ORDER BY rank) AS urls FROM r GROUP BY query_id""",
        "query_rejects": """SELECT doc_id, CASE lang WHEN 'fr' THEN 'missing query' WHEN 'de' THEN 'empty query'
            ELSE 'blank query' END AS reason FROM documents WHERE lang IN ('fr', 'de', 'es')""",
        "pca_spectrum_moments": MOMENTS,
        "pca_spectrum_by_factors": MOMENTS,
        "pca_near_singular": """WITH p AS (SELECT l_extendedprice::DOUBLE / 1e4 AS a, l_quantity::DOUBLE AS d FROM lineitem)
            SELECT 2::INT AS component, round(log10((var_pop(a) * var_pop(d) - covar_pop(a, d) ** 2) / var_pop(a) ** 2 * 1e-20 / 4), 3) AS magnitude FROM p""",
        "pca_distances": f"""WITH {ITEMS}, {CELLS},
            s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM cells GROUP BY dim)
            SELECT id, round(sqrt(sum(((x - m) / sd) ** 2)), 6) AS length FROM cells JOIN s USING (dim) GROUP BY id""",
        "search_standardised": f"""WITH {ITEMS}, {CELLS},
            s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS sd FROM cells GROUP BY dim),
            z AS (SELECT id, list((x - m) / sd ORDER BY dim) AS std FROM cells JOIN s USING (dim) GROUP BY id),
            i AS (SELECT items.*, z.std FROM items JOIN z USING (id)),
            q AS (SELECT id AS query_id, cluster_id, std FROM i) {pairs_sql('i', 'q', 20, 'std')}""",
        "lloyd_from_label_means": f"""WITH {ITEMS}, {CELLS}, {MEANS},
            a1 AS {nearest_sql('cells', 'means')},
            m1 AS (SELECT a.cluster_id, dim, avg(x) AS m FROM cells JOIN a1 a USING (id) GROUP BY a.cluster_id, dim),
            a2 AS {nearest_sql('cells', 'm1')},
            m2 AS (SELECT a.cluster_id, dim, avg(x) AS m FROM cells JOIN a2 a USING (id) GROUP BY a.cluster_id, dim),
            a3 AS {nearest_sql('cells', 'm2')},
            c AS (SELECT cluster_id, round(sum(m), 6) AS center_sum FROM m2 GROUP BY cluster_id)
            SELECT cluster_id, count(*) AS size, center_sum, (SELECT round(sum(square), 6) FROM a3) AS total_sse
            FROM a3 JOIN c USING (cluster_id) GROUP BY cluster_id, center_sum""",
        "sweep_recomputed": """SELECT k::INT AS k, rows, k AS clusters, true AS agree
            FROM (SELECT count(*) AS rows FROM embeddings), (SELECT unnest(range(1, 103, 3)) AS k)""",
        "secondary_complete": "SELECT count(*) AS rows, count(*) AS keyed FROM embeddings",
        "sweep_of_one": f"""WITH {ITEMS}, {CELLS}, {MEANS}
            SELECT cluster_id, 1 AS k, round(sum((x - m) * (x - m)), 6) AS sse
            FROM cells JOIN means USING (cluster_id, dim) GROUP BY cluster_id""",
        "elbow_price_bins": f"""WITH o AS (SELECT o_orderpriority AS curve, o_totalprice AS v,
              min(o_totalprice) OVER (PARTITION BY o_orderpriority) AS lo,
              max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS hi FROM orders),
            b AS (SELECT curve, k, v, least(k - 1, floor(k * ((v - lo) / (hi - lo)))) AS bin
              FROM o, (SELECT unnest(range(1, 50, 3)) AS k)),
            e AS (SELECT curve, k, var_pop(v) * count(*) AS sse FROM b GROUP BY curve, k, bin),
            curves AS (SELECT curve, k AS x, sum(sse) AS y FROM e GROUP BY curve, k),
            {elbow_sql('curves')}""",
        "gmm_event_values": em_sql(),
        "gmm_label_rows": f"""WITH {', '.join(em_steps())}, b AS (SELECT event_id, arg_max(c, lp) AS gmm_cluster_id FROM j3 GROUP BY event_id)
            SELECT event_id, gmm_cluster_id::INT AS gmm_cluster_id FROM b WHERE gmm_cluster_id = 0""",
        "gmm_criteria_given": f"SELECT * FROM {criteria_sql(1, '0')} UNION ALL SELECT * FROM {criteria_sql(2, '(value > 50)::INT')}",
        "sweep_given_starts": sweep_sql(),
        "sweep_by_marks": sweep_sql(8),
        "kmeans_fills_clusters": """WITH v AS (SELECT count(DISTINCT (l_quantity, l_linenumber)) AS values, count(*) AS rows FROM lineitem)
            SELECT k, restart, least(k, values)::BIGINT AS filled, rows FROM v, (SELECT unnest([20, 200])::INT AS k), (SELECT unnest(range(3))::INT AS restart)""",
        "secondary_given": f"""WITH {ITEMS}, {CELLS}, {MEANS},
            d AS (SELECT id, c.cluster_id % 3 AS g, m.cluster_id AS label, sum((c.x - m.m) ** 2) AS square
              FROM cells c JOIN means m ON c.dim = m.dim AND c.cluster_id % 3 = m.cluster_id % 3 GROUP BY ALL)
            SELECT id, g::INT AS gmm_cluster_id, (arg_min(label, square) // 3)::INT AS secondary_cluster_id FROM d GROUP BY id, g""",
        "pca_two_columns": """WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem),
            c AS (SELECT 1 AS component, (1 + r) / 2 AS ratio, (1 + r) / 2 AS cumulative, r FROM r
              UNION ALL SELECT 2, (1 - r) / 2, 1.0, r FROM r)
            SELECT component, round(ratio, 6) AS ratio, round(cumulative, 6) AS cumulative, CASE WHEN (1 + r) / 2 > 0.9 THEN 1 ELSE 2 END AS kept FROM c""",
        "index_centroids": f"""WITH {GIVEN}, n AS (SELECT cluster_id, round(sqrt(sum(m * m)), 6) AS centroid_length FROM zm GROUP BY cluster_id)
            SELECT id, cluster_id, centroid_length FROM i JOIN n USING (cluster_id)""",
        "queries_refused": """WITH q AS (SELECT vec_id % 10 AS d FROM embeddings)
            SELECT CASE d WHEN 1 THEN 'wrong width' WHEN 2 THEN 'missing query' WHEN 3 THEN 'missing id' WHEN 4 THEN 'repeated id'
              ELSE 'answered' END AS reason, count(*) AS queries FROM q GROUP BY reason""",
        "build_sets_aside": """WITH q AS (SELECT vec_id % 10 AS d FROM embeddings)
            SELECT CASE d WHEN 3 THEN 'missing id' WHEN 4 THEN 'repeated id' ELSE 'stored' END AS reason, count(*) AS rows FROM q GROUP BY reason""",
        "search_text_given": f"""WITH {GIVEN.replace(ITEMS, TEXTS).split('q AS (')[0]}
            b AS (SELECT key AS id, encd FROM {encoded_sql("(SELECT * FROM benchmark WHERE item_id % 4 <> 3)", 'item_id')}),
            bc AS (SELECT id, dim, (x - m) / sd AS x FROM (SELECT id, unnest(encd) AS x, (generate_subscripts(encd, 1) - 1)::INT AS dim FROM b) JOIN s USING (dim)),
            q AS (SELECT n.id AS query_id, n.cluster_id, v.std FROM {nearest_sql('bc', 'zm')} n
              JOIN (SELECT id, list(x ORDER BY dim) AS std FROM bc GROUP BY id) v USING (id)),
            u AS (SELECT 'texts_' || lpad(doc_id::VARCHAR, 12, '0') AS id, '{URL}' || lpad(doc_id::VARCHAR, 12, '0') || '.jpg' AS address FROM documents),
            r AS ({pairs_sql('i', 'q', 10, 'std')})
            SELECT query_id::BIGINT AS query_id, string_agg(address, chr(10) ORDER BY rank) AS urls FROM r JOIN u USING (id) GROUP BY query_id
            UNION ALL SELECT -count(*), 'blank query' FROM benchmark WHERE item_id % 4 = 3 HAVING count(*) > 0""",
        "gmm_line_items": plane_em_sql(),
        "index_finds_itself": "SELECT count(*) AS queries, count(*) AS hits FROM embeddings",
        "index_keeps_clusters": "SELECT count(*) AS same FROM embeddings",
        "search_coded_given": f"WITH {GIVEN} {pairs_sql('i', 'q', 20, 'std')}",
        "coded_bounds": f"WITH {GIVEN} SELECT cluster_id, (count(*) * count(*))::BIGINT AS pairs, (count(*) * count(*))::BIGINT AS held FROM i GROUP BY cluster_id",
        "sub_sweep_given": sub_sweep_sql(),
        "secondary_fitted_given": secondary_fitted_sql(),
        "fit_index_given": fit_index_sql(),
        "keyed_lists": f"""WITH {keyed_sql(1)} SELECT gmm::INT AS gmm_cluster_id, inside::INT AS secondary_cluster_id, count(*) AS rows, min(id) AS first
            FROM i GROUP BY gmm, inside""",
        "search_keyed_given": f"WITH {keyed_sql(1)} {pairs_sql('i', 'q', 20, 'std')}",
        "search_keyed_two_lists": f"WITH {keyed_sql(2)} {pairs_sql('i', 'q', 20, 'std')}",
        "search_keyed_fitted": "SELECT count(*) AS queries, count(*) AS hits FROM embeddings",
        "search_given_index": f"WITH {GIVEN} {pairs_sql('i', 'q', 20, 'std')}",
        "search_given_index_one": f"""WITH {GIVEN}, r AS ({pairs_sql('i', 'q', 20, 'std')})
            SELECT rank, id, img_name, url, similarity FROM r WHERE query_id = 'images_000000000019'""",
        "index_upsert": f"WITH {ITEMS} SELECT id, dataset, url, len(encd)::INT AS width FROM items",
        "encode_documents": f"""WITH {TEXTS} SELECT id, round(list_sum(list_transform(encd, lambda x, i: x * i)), 6) AS weighted,
            round(list_sum(encd), 6) AS total, round(sqrt(list_sum(list_transform(encd, lambda x: x * x))), 6) AS length
            FROM items""",
        "search_text_by_language": f"""WITH {TEXTS}, {CELLS}, {MEANS},
            b AS (SELECT key AS id, encd FROM {encoded_sql('benchmark', 'item_id')}),
            bc AS (SELECT id, unnest(encd) AS x, (generate_subscripts(encd, 1) - 1)::INT AS dim FROM b),
            q AS (SELECT b.id AS query_id, cluster_id, encd FROM b JOIN {nearest_sql('bc', 'means')} n USING (id)),
            r AS ({pairs_sql('items', 'q', 10)}) SELECT query_id, rank, id, similarity FROM r""",
    }
    found["stream_text"] = found["search_text_given"]
    if corpus is not None:
        found |= corpus.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
