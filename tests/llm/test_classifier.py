import random

from vecshoal.llm import classifier

from .conftest import EDGE


def labelled(spark, documents, prose, count=400):
    rng = random.Random(3)
    texts, labels = [], []
    for number, text in enumerate(prose(count, seed=5)):
        junk = number % 4 == 0
        if junk:
            text = " ".join(w + rng.choice(["%%%", "$$$", "!!"]) for w in text.upper().split())
        texts.append(text)
        labels.append((number, 0 if junk else 1))
    return documents(texts), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark, documents, prose):
    docs, labels = labelled(spark, documents, prose)
    model = classifier.train(docs, labels.where("doc_id % 3 <> 2"))
    held = model.score(docs).join(labels.where("doc_id % 3 = 2"), "doc_id").collect()
    right = [(row.score >= 0.7) == (row.quality == 1) for row in held]
    assert len(right) > 100 and sum(right) >= 0.97 * len(right)
    assert all(0 <= row.score <= 1 for row in held)


def test_same_rows_give_the_same_model(spark, documents, prose):
    docs, labels = labelled(spark, documents, prose, 120)
    one, two = classifier.train(docs, labels), classifier.train(docs.repartition(5), labels.repartition(2))
    assert abs(one.weights - two.weights).max() < 1e-9


def test_bound_on_training_rows(spark, documents, prose):
    docs, labels = labelled(spark, documents, prose, 400)
    sample = classifier.labelled_sample(docs, labels, "quality", 100, "doc_id", "text")
    assert 60 < sample.count() < 140


def test_edges(spark, documents, prose):
    docs, labels = labelled(spark, documents, prose, 80)
    model = classifier.train(docs, labels.unionByName(spark.createDataFrame([(1, None), (1, 1), (None, 0)], labels.schema)))
    odd = documents(EDGE).selectExpr("*", "'x' as score", "1 as _id")
    rows = {row.doc_id: row.score for row in model.score(odd).collect()}
    assert len(rows) == len(EDGE) and rows[0] == rows[1] == rows[2]
    assert model.score(documents([])).count() == 0
    twice = model.score(documents([(1, "a b"), (1, "a b")])).collect()
    assert twice[0].score == twice[1].score
    untrained = classifier.train(docs, labels.limit(0)).score(docs).select("score").distinct().collect()
    assert [row.score for row in untrained] == [0.5]
