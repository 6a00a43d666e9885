import re
from collections import Counter

from vecshoal.llm import rules

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_counts_against_brute_force(documents, prose):
    texts = [*EDGE, "one long line of words " * 30_000 + "end", "a b c a b c x a b", "a a a a", "\x0b\x0c x\x85y z\xa0w #*$%&|<>", *prose(40), *("\n".join([t, t]) for t in prose(5, seed=2))]
    rows = {r.doc_id: r for r in rules.apply_rules(documents(texts)).collect()}
    for number, text in enumerate(texts):
        want = brute(text)
        assert counts(rows[number]) == want, text
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert rows[number].base_failed == failed
        assert not (failed and rows[number].kept)


def test_thresholds_follow_the_data(spark, documents, prose):
    """A share of symbols that is odd in one source is usual in another."""
    plain, marked = prose(60, seed=1), ["\n".join(w + "#" for w in t.split()) for t in prose(60, seed=2)]
    rows = [(n, t, "en", "a", 0) for n, t in enumerate(plain)] + [(100 + n, t, "en", "b", 0) for n, t in enumerate(marked)]
    rows += [(300, marked[0], "en", "a", 0)]
    docs = spark.createDataFrame(rows, documents([]).schema)
    kept = {r.doc_id: r.kept for r in rules.apply_rules(docs, least_rows=20).collect() if not r.base_failed}
    assert not kept.get(300, False)
    assert all(kept[n] for n in kept if n < 300)


def test_chance_counts_do_not_reject(spark, documents, prose):
    """Where no document has symbols the fence is 0: a few symbols are chance, many are not."""
    rows = [(n, t, "en", "a", 0) for n, t in enumerate(prose(60, seed=1))]
    long = " ".join(f"word{n}" for n in range(200))
    rows += [(100 + n, long + " #" * n, "en", "a", 0) for n in (1, 9, 10, 40)]
    kept = {r.doc_id: r.kept for r in rules.apply_rules(spark.createDataFrame(rows, documents([]).schema), least_rows=20, reach=50.0).collect()}
    # Of 10 symbols 3 times the root of 10 are chance.
    assert [kept[100 + n] for n in (1, 9, 10)] == [True, True, False]


def test_repeats_are_fenced_among_documents_that_have_any(spark, documents):
    words = lambda n, seed: " ".join(f"w{seed}x{i}" for i in range(n))
    rows = [(n, words(100, n), "en", "a", 0) for n in range(80)]
    some = lambda n, times: "\n".join([*(words(4, f"{n}y{i}") for i in range(100)), *["same line"] * (times + 1)])
    rows += [(100 + n, some(n, 5 + n % 5), "en", "a", 0) for n in range(30)] + [(300, some(300, 90), "en", "a", 0)]
    kept = {r.doc_id: r.kept for r in rules.apply_rules(spark.createDataFrame(rows, documents([]).schema), least_rows=20, reach=3.0).collect()}
    assert not kept[300] and all(kept[100 + n] for n in range(30))


def test_small_groups_take_the_thresholds_above(spark, documents, prose):
    rows = [(n, t, "en", "a", 0) for n, t in enumerate(prose(60, seed=1))]
    rows += [(100, " ".join(w + "#" for w in rows[0][1].split()), "en", "rare", 0), (101, " ".join(w + "#" for w in rows[1][1].split()), None, None, 0)]
    docs = spark.createDataFrame(rows, documents([]).schema)
    kept = {r.doc_id: r.kept for r in rules.apply_rules(docs, least_rows=20).collect()}
    assert not kept[100] and not kept[101]


def test_edges(documents):
    assert rules.apply_rules(documents([])).count() == 0
    odd = documents([(1, "a b"), (1, "a b"), (None, None)]).selectExpr("*", "1 as kept", "2 as n_words", "3 as _words", "4 as level")
    rows = rules.apply_rules(odd).collect()
    assert [r.kept for r in rows] == [False] * 3
