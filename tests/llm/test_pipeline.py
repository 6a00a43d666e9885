import random

import corpus_pipeline
from pyspark.sql import functions as F

from vecshoal.llm import queries

from .conftest import DOCUMENTS
from .test_jaccard import brute as brute_classes
from .test_lines import brute as brute_lines
from .test_mixing import brute as brute_mix


def corpus(spark, prose, tmp_path):
    rng = random.Random(2)
    texts = prose(150, seed=12, words=90)
    for number in range(0, 150, 10):
        texts.append(texts[number])
        words = texts[number + 1].split(" ")
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    rows, labels = [], []
    for number, text in enumerate(texts):
        junk = number % 6 == 5
        if junk:
            text = " ".join(w + rng.choice(["%%%", "$$$"]) for w in text.split())
        rows.append((number, text, ["en", "de"][number % 2], f"src{number % 14}", len(text)))
        labels.append((number, 0 if junk else 1, 0))
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows, dict((d, q) for d, q, _ in labels)


def test_stages_against_brute_force(spark, prose, tmp_path):
    rows, labels = corpus(spark, prose, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    def run(stage, table):
        out = stage(spark, table, str(tmp_path))
        return out, sorted(tuple(r) for r in out.collect())

    docs, kept = run(stages[0], docs)
    assert docs.columns == list(corpus_pipeline.COLUMNS)
    right = sum(labels[d] == 1 for d, *_ in kept) + sum(q == 0 for d, q in labels.items() if d not in {k[0] for k in kept})
    assert right >= 0.98 * len(labels) and all(r in rows for r in kept)

    docs = spark.createDataFrame(kept, DOCUMENTS)
    docs, cut = run(stages[1], docs)
    want = brute_lines([(r[0], r[1]) for r in kept])
    assert [(r[0], r[1]) for r in cut] == want
    assert [r[2:] for r in cut] == [(*r[2:4], len(t)) for r, (_, t) in zip(kept, want)]

    docs = spark.createDataFrame(cut, DOCUMENTS)
    docs, single = run(stages[2], docs)
    heads = {told for told, _ in brute_classes([(r[0], r[1]) for r in cut]).values()}
    assert single == [r for r in cut if r[0] in heads]

    docs = spark.createDataFrame(single, DOCUMENTS)
    _, mixed = run(stages[3], docs)
    curated = [(d, t, lang, source, "web" if len(source) == 4 else "curated") for d, t, lang, source, _ in single]
    taken = brute_mix([(d, t, lang, source, 0) for d, t, lang, source, _ in curated], queries.WEIGHTS, 0.8, 1, 17, domain=lambda s: "web" if len(s) == 4 else "curated")
    assert [r[0] for r in mixed] == sorted(taken) and mixed == [r for r in single if r[0] in taken]


def test_run_is_the_stages_in_turn(spark, prose, tmp_path):
    corpus(spark, prose, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), DOCUMENTS)
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("tokens"))
    assert {r.doc_id: r.n for r in whole.collect()} == {r.doc_id: r.tokens for r in whole.collect()}
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in docs.collect())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
