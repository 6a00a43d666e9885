import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [None, "", " \n\t ", "word", "\n\n", "äöü ß 漢字 😀", "a " * 3000, "x" * 5000, "same line here\nsame line here"]


@pytest.fixture
def documents(spark):
    """A maker of documents tables from texts, or from ``(doc_id, text)`` pairs."""

    def make(texts, **extra):
        rows = []
        for number, one in enumerate(texts):
            doc_id, text = one if isinstance(one, tuple) else (number, one)
            rows.append((doc_id, text, "en" if number % 3 else None, f"src{number % 12}" if number % 5 else None, None if text is None else len(text)))
        return spark.createDataFrame(rows, DOCUMENTS).repartition(3)

    return make


@pytest.fixture
def prose():
    """Seeded invented texts of sentences."""

    def make(count, seed=0, words=120):
        rng = random.Random(seed)
        vocabulary = ["the", "of", "and", "in", "to"] + ["".join(rng.choice(["an", "er", "th", "on", "re", "ti"]) for _ in range(rng.randint(1, 4))) for _ in range(600)]
        out = []
        for _ in range(count):
            lines, line = [], []
            for _ in range(rng.randint(words // 4, words)):
                line.append(rng.choice(vocabulary))
                if rng.random() < 0.08:
                    lines.append(" ".join(line) + ".")
                    line = []
            out.append("\n".join([*lines, " ".join(line)]))
        return out

    return make
