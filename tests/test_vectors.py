import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecshoal.functions import keys, vectors
from vecshoal.functions.encode import HashingEncoder, encode_text
from vecshoal.sources import items as source


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(values_schema(values)))
    return df.select(column.alias("x")).first().x


def values_schema(values):
    for name, value in values.items():
        yield f"{name} array<double>" if isinstance(value, list) or value is None else f"{name} string"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("[0.1, 0.2,3]", [0.1, 0.2, 3.0]),
        ("[1e-3]", [0.001]),
        ("[ -2.5 , 7 ]", [-2.5, 7.0]),
        ("[0.1, word]", [0.1, None]),
        ("[]", [None]),
    ],
)
def test_parse_bracketed(spark, text, expected):
    assert one(spark, vectors.parse_bracketed(F.col("t")), t=text) == expected


def test_parse_bracketed_strict_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, vectors.parse_bracketed(F.col("t"), strict=True), t="[0.1, word]")


def test_parse_json(spark):
    assert one(spark, vectors.parse_json(F.col("t")), t="[0.25, -1]") == [0.25, -1.0]
    assert one(spark, vectors.parse_json(F.col("t")), t="(0.25)") is None


def test_similarity(spark):
    a, b = [1.0, 2.0, -3.0], [0.5, 4.0, 1.0]
    expected = np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(expected)
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=a, b=[0.0, 0.0, 0.0]) == 0.0
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=a, b=None) is None
    assert one(spark, vectors.squared_distance(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(20.25)


def test_width_is_null_for_null(spark):
    assert one(spark, vectors.width(F.col("a")), a=None) is None
    assert one(spark, vectors.first_elements(F.col("a"), 2), a=[1.0, 2.0, 3.0]) == [1.0, 2.0]


def test_wide_columns_of_a_short_vector(items):
    wide = vectors.wide_columns(items([("a", [1, 2], 0)]), "encd", 3).first()
    assert (wide.encd_0, wide.encd_1, wide.encd_2) == (1.0, 2.0, None)


def test_item_id_needs_both_parts(spark):
    rows = spark.createDataFrame([("images", "7"), ("images", None)], "d string, n string")
    found = [r.x for r in rows.select(keys.item_id(F.col("d"), F.col("n")).alias("x")).collect()]
    assert found == ["images_7", None]


def test_defects(spark):
    rows = [
        ("ok", [1.0, 2.0]),
        ("none", None),
        ("short", [1.0]),
        ("long", [1.0, 2.0, 3.0]),
        ("word", [1.0, None]),
        ("nan", [1.0, math.nan]),
        ("inf", [math.inf, 1.0]),
        (None, [1.0, 2.0]),
    ]
    table = spark.createDataFrame(rows, "id string, encd array<double>")
    good, bad = source.split_valid(table, 2)
    assert [r.id for r in good.collect()] == ["ok"]
    assert {r.id: r.reason for r in bad.collect()} == {
        "none": "missing vector",
        "short": "wrong width",
        "long": "wrong width",
        "word": "not a number",
        "nan": "not a number",
        "inf": "not a number",
        None: "missing id",
    }


def test_encoder(spark):
    texts = ["a b  a", "", None, "B\tA a"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    found = {r.i: r.v for r in rows.select("i", encode_text(F.col("t"), lambda: HashingEncoder(8)).alias("v")).collect()}
    assert found[0] == found[3]
    assert np.linalg.norm(found[0]) == pytest.approx(1.0)
    assert found[1] == [0.0] * 8
    assert found[2] is None


class FewTexts:
    """An encoder that takes few texts at a time."""

    def encode(self, texts):
        assert 0 < len(texts) <= 256
        return [[float(len(text)), 1.0] for text in texts]


def test_an_encoder_gets_few_texts_at_a_time(spark):
    rows = spark.createDataFrame([(n, None if n % 7 == 0 else "x" * (n % 50)) for n in range(1500)], "n int, text string").coalesce(1)
    found = rows.withColumn("v", encode_text(F.col("text"), FewTexts)).collect()
    assert all(r.v == (None if r.n % 7 == 0 else [float(r.n % 50), 1.0]) for r in found)
