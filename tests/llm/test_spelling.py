import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecshoal.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(words, least_length=6, least_count=5, times=5):
    n = {w: c for w, c in Counter(w for w in words if w is not None).items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def invented(seed, count, letters="abné"):
    """Words, many of them near others, with frequencies far apart."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
        for _ in range(rng.randint(1, 4)):
            out += [word] * rng.choice([1, 5, 6, 30, 160, 900])
            at = rng.randrange(len(word) + 1)
            word = word[:at] + rng.choice(["", rng.choice(letters)]) + word[at + rng.randint(0, 1) :]
    return out


def got(spark, words, **how):
    rows = spark.createDataFrame([(w, 1, 2, 3) for w in words], "word string, n int, root int, piece int").repartition(3)
    return [tuple(r) for r in spelling.group_variants(rows, **how).collect()]


@pytest.mark.parametrize("most", [50_000, 7])
def test_against_all_pairs(spark, most):
    words = invented(1, 60) + invented(2, 40, "ab") + ["x" * 3000] * 6 + ["x" * 1500 + "y" + "x" * 1499] * 40 + ["😀" * 6] * 5 + ["😀" * 7] * 30 + ["short"] * 9 + [None] * 9
    found = got(spark, words, most=most)
    assert len(found) == len(set(found)) and set(found) == brute(words)
    assert any(row[2] not in (row[0], row[1]) for row in found)


def test_other_bounds_and_no_words(spark):
    words = invented(3, 30, "abc")
    assert set(got(spark, words, least_length=7, least_count=1, times=2)) == brute(words, 7, 1, 2)
    assert got(spark, []) == [] and got(spark, [None, "", "rare words only"]) == []


def test_equal_frequencies_go_by_code_points(spark):
    words = ["abcdef"] * 5 + ["abcdeg"] * 25 + ["abcdeé"] * 25 + ["abcdeZ"] * 25
    assert ("abcdef", "abcdeZ", "abcdeZ", 5, 3, 25) in got(spark, words)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=7), min_size=1, max_size=25, unique=True), st.lists(st.text("abc", min_size=2, max_size=7), max_size=12))
def test_search_finds_all_words_one_error_away(words, others):
    words = sorted(words)
    asked = words + others
    index = spelling.WordIndex(words)
    for rightwards in (True, False):
        pairs = {(asked[q], words[w]) for q, w in zip(*index.near(asked, rightwards))}
        for q in asked:
            half = q[: len(q) // 2] if rightwards else q[len(q) // 2 :]
            want = {w for w in words if one_edit(q, w) and (w.startswith(half) if rightwards else w.endswith(half))}
            assert {w for p, w in pairs if p == q} == want


@settings(max_examples=100, deadline=None)
@given(st.text("ab", min_size=1, max_size=30))
def test_rotations(text):
    text = "$" + text
    order = spelling.rotations(spelling.code_points([text]))
    assert list(order) == sorted(range(len(text)), key=lambda i: text[i:] + text[:i])


def test_query_reads_texts_of_any_kind(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "Wörtchen " * 6 + "a" * 9000, "12 34", "WÖRTCHEN wörtchen"])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r.word, r.n) for r in queries.op11_spelling_variants(spark, str(tmp_path)).collect()] == [("wörtchen", 7)]
