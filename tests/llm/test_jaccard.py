import random
from collections import defaultdict

import pytest

from vecshoal.llm import components, jaccard

from .conftest import EDGE


def grams(text, n=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, min(1, len(words)))))


def brute(rows, threshold=0.8):
    """``row: (class members, links)`` from all pairs of distinct sets."""
    sets = sorted({grams(t) for _, t in rows}, key=lambda s: sorted(s))
    root = list(range(len(sets)))
    links = [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    number = {s: n for n, s in enumerate(sets)}
    members = defaultdict(list)
    for doc_id, text in rows:
        members[find(number[grams(text)])].append(doc_id)
    return {(d, t): (min((m for m in members[find(number[grams(t)])] if m is not None), default=None), links[number[grams(t)]]) for d, t in rows}


def families(prose, seed, count=25, copies=6):
    rng = random.Random(seed)
    out = []
    for text in prose(count, seed=seed, words=140):
        out.append(text)
        for _ in range(rng.randrange(copies)):
            words = text.split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
            out.append(" ".join(words) if rng.random() < 0.7 else text.upper())
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"brute": 3, "depth": 4}, {"block_rows": 3}])
def test_against_all_pairs(documents, prose, options):
    rows = list(enumerate([*families(prose, 3), *EDGE]))
    got = {(r.doc_id): (r.class_id, r.n_links) for r in jaccard.near_duplicates(documents(rows), **options).collect()}
    want = {d: told for (d, _), told in brute(rows).items()}
    assert got == want


def test_one_large_group(documents):
    """Hundreds of texts, each alike to all others."""
    base = [f"w{n}" for n in range(120)]
    rows = [(n, " ".join([*base[:60], f"own{n}", *base[60:]])) for n in range(400)]
    got = jaccard.near_duplicates(documents(rows), brute=50, block_rows=90).collect()
    assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {399}
    assert [r.doc_id for r in jaccard.one_of_each(documents(rows), brute=50, block_rows=90).collect()] == [0]


def test_one_of_each_keeps_columns(documents, prose):
    texts = families(prose, 8)
    rows = [*enumerate(texts), (None, "a text without an id that stands alone here"), (3, texts[3]), (None, None), (99, "")]
    docs = documents(rows).selectExpr("*", "1 as id", "2 as own", "3 as sid", "4 as doc")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    told = brute(rows)
    want = sorted({c for c, _ in told.values() if c is not None})
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in got) == 1


def test_pairs_in_a_large_group_of_a_common_pool(documents):
    """Pairs at 0.80 to 0.85 among sets whose words all come from one pool, where runs go deep before buckets are small."""
    rng = random.Random(2)
    pool = [f"w{n}" for n in range(200)]
    rows, pairs = [], []
    for n in range(900):
        words = rng.sample(pool, 140)
        rows.append((n, " ".join(words)))
        if n < 300:
            new = rng.sample(sorted(set(pool) - set(words)), rng.randint(12, 15))
            rows.append((10_000 + n, " ".join([*new, *words[len(new) :]])))
            pairs.append((n, 10_000 + n))
    got = {r.doc_id: r.class_id for r in jaccard.near_duplicates(documents(rows), n=1, coordinates=256, brute=5, depth=10, alike=0.95).collect()}
    assert [pair for pair in pairs if got[pair[1]] != pair[0]] == []
    assert all(got[n] == n for n in range(900))


def test_chance_missed():
    """Against drawn numbers of equal tokens; and the runs that a depth needs."""
    import numpy as np

    least, allowed = jaccard.least_equal(0.8, 64, 0.999)
    equal = np.random.default_rng(1).binomial(64, 0.8, 400_000)
    drawn = ((equal >= least) * (1 - (equal / 64) ** 2) ** 3 * (1 - (equal / 64) ** 6) ** 9).mean()
    told = jaccard.chance_missed(np.array([[0, 3, 0, 0, 0, 9]]), 0.8, 64, least)[0]
    assert abs(drawn - told) < 0.002
    assert (equal < least).mean() + allowed <= 0.00125 and allowed < 0.001


def test_empty(documents):
    assert jaccard.near_duplicates(documents([])).count() == 0
    assert jaccard.one_of_each(documents([])).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + n, 1001 + n) for n in range(120)] + [(5000, 5000 + n) for n in range(200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found, _ = components.components(spark.createDataFrame(links, "a long, b long").repartition(3), "test")
    got = {r.a: r.b for r in found.collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
