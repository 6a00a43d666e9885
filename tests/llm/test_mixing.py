import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from vecshoal.llm import mixing, queries

from .conftest import DOCUMENTS, EDGE



def levels():
    return F.substring("source", 1, 1), F.col("lang"), F.col("source")


def pour(budget, children):
    """Shares of ``children`` (name: (weight, room)) by raising the level step by step."""
    given = {}
    open_ = {c: wr for c, wr in children.items() if wr[0] > 0}
    budget = min(budget, sum(r for _, r in open_.values()))
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [c for c, (w, r) in open_.items() if r <= (budget * w / total) * (1 + 1e-12)]
        if not full:
            return given | {c: budget * w / total for c, (w, _) in open_.items()}
        for c in full:
            given[c] = open_.pop(c)[1]
            budget -= given[c]
    return given


def brute(rows, weights, share, epochs, seed, domain=lambda source: source[:1]):
    """Times each document is taken: ``{doc_id: n}``."""
    leaves = defaultdict(list)
    for doc_id, text, lang, source, _ in rows:
        leaves[(domain(source or ""), lang or "", source or "")].append((doc_id, len((text or "").split())))
    total = sum(t for docs in leaves.values() for _, t in docs)
    room = lambda path: epochs * sum(t for p, docs in leaves.items() if p[: len(path)] == path for _, t in docs)
    below = {(): min(total * share, total * epochs)}
    for depth in range(3):
        after = {}
        for parent, budget in below.items():
            names = {p[: depth + 1] for p in leaves if p[:depth] == parent}
            after |= pour(budget, {p: (weights[depth].get(p[-1], 1.0), float(room(p))) for p in names})
        below = after
    taken = {}
    for path, budget in below.items():
        docs, words = leaves[path], int(budget + 1e-6)
        has = sum(t for _, t in docs)
        passes = words // has if has else 0
        rest = words - passes * has
        order = sorted(docs, key=lambda d: hashlib.md5(f"{seed}:{passes}:{d[0]}".encode()).hexdigest())
        upto = 0
        for doc_id, tokens in order:
            upto += tokens
            if n := passes + (upto <= rest):
                taken[doc_id] = n
    return taken


def rows_of(prose):
    texts = [*prose(300, seed=9, words=80), *EDGE]
    return [(n, t, ["en", "de", "fr"][n % 3 if n % 7 else 0], f"{'ab'[n % 11 == 0]}{n % 4 if n % 2 else 0}", 0) for n, t in enumerate(texts)]


@pytest.mark.parametrize(
    ("weights", "share", "epochs"),
    [(({}, {}, {}), 0.5, 1), (({"b": 3.0}, {"en": 0.1, "fr": 5.0}, {"a0": 2.0}), 0.7, 2), (({"a": 0.0}, {}, {}), 0.9, 3), (({}, {"de": 9.0}, {}), 2.5, 2)],
)
def test_against_step_by_step_budgets(spark, prose, weights, share, epochs):
    rows = rows_of(prose)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    chosen = mixing.choose(docs, levels(), weights, budget_share=share, max_epochs=epochs, seed=3)
    assert {r.doc_id: r.epochs for r in chosen.collect()} == brute(rows, weights, share, epochs, 3)


def test_shortage_stays_among_siblings(spark):
    """What a source lacks comes from its language, not from another one, as long as that has room."""
    rows = [(n, "w " * 10, "en", "a1", 0) for n in range(10)] + [(100 + n, "w " * 10, "en", "a2", 0) for n in range(200)]
    rows += [(500 + n, "w " * 10, "de", "a3", 0) for n in range(200)]
    chosen = mixing.choose(spark.createDataFrame(rows, DOCUMENTS), levels(), ({}, {}, {}), budget=2000, max_epochs=1)
    got = {r.lang: r.tokens for r in chosen.groupBy(F.col("l2").alias("lang")).agg(F.sum("tokens").alias("tokens")).collect()}
    assert got == {"en": 1000, "de": 1000}


def test_documents_once_per_pass(spark, prose):
    rows = [(n, t, "en", "a", 0) for n, t in enumerate(prose(20))]
    docs = spark.createDataFrame([*rows, rows[3], (None, "no id", None, None, None)], DOCUMENTS).selectExpr("*", "1 as id", "2 as leaf", "3 as _epoch")
    mixed = mixing.mix(docs, levels(), ({}, {}, {}), budget_share=2.0, max_epochs=2, epoch="epoch")
    assert mixed.columns == [*docs.columns, "epoch"]
    got = sorted((r.doc_id, r.epoch) for r in mixed.collect() if r.doc_id is not None)
    assert got == [(n, e) for n in range(20) for e in range(2)]
    assert mixing.choose(docs.limit(0), levels(), ({}, {}, {})).count() == 0


def test_sql_agrees(spark, prose, tmp_path):
    rows = [(n, t, lang, f"src{n % 13}", 0) for n, t, lang, _, _ in rows_of(prose)]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op4_mix_hierarchy(spark, str(tmp_path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = base.execute(queries.SQL["op4_mix_hierarchy"]).df().sort_values("doc_id").reset_index(drop=True)
    assert found[sorted(found)].equals(want[sorted(want)])
