import math
import re
from collections import Counter

import pytest

from vecshoal.llm import ranked

from .conftest import EDGE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, tf, sum(tf.values())) for doc, tf in counted if tf]
    documents, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(term for _, tf, _ in counted for term in tf)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, those in wanted.items():
        scored = []
        for doc, tf, n in counted:
            m = 100 - 90 + (90 * n * documents) // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in those if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def got(spark, docs, items, **how):
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in docs], "doc_id long, text string, n int, term int, score int").repartition(4)
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    return sorted((tuple(r) for r in ranked.search(docs, items, **how).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def corpus(prose):
    texts = prose(60, seed=8)
    docs = list(enumerate([*EDGE, *texts, *texts[:20], texts[0], "Ünï 漢字 A1 a1", "the " * 50_000]))
    docs += [(None, texts[5]), (3, texts[6]), (3, texts[6]), (500, texts[5] + " the")]
    items = [(f"i{n}", text) for n, text in enumerate(prose(12, seed=9, words=30))]
    items += [("copy", texts[0]), ("five", texts[5]), ("none", None), ("empty", ""), ("unknown", "zzzzq"), ("odd", "ünï Ünï 漢字 A1"), ("two", "the"), ("two", "of and"), (None, "to"), ("i0", items[0][1])]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"k": 3, "block_bytes": 200}, {"k": 1}])
def test_against_all_pairs(spark, corpus, how):
    assert got(spark, *corpus, **how) == brute(*corpus, how.get("k", 10))


def test_small_steps_of_a_task(spark, corpus, monkeypatch):
    whole = ranked.best_of_tasks
    monkeypatch.setattr(ranked, "best_of_tasks", lambda *a: whole(*a, step=40))
    assert got(spark, *corpus) == brute(*corpus, 10)


def test_no_documents_or_items(spark):
    assert got(spark, [], [("a", "word")]) == [] and got(spark, [(1, "word"), (2, "word other")], []) == []
    assert got(spark, [(1, None), (2, " .,")], [("a", "word")]) == []
