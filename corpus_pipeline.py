"""The training-data pipeline: each stage reads what the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.llm import classifier, jaccard, lines, mixing, packing
from vecshoal.llm.common import stored
from vecshoal.llm.queries import WEIGHTS, mix_levels

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classifier.train(docs, labels).score(docs, keep=COLUMNS)
    return scored.where(F.col("score") >= 0.7).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or near-equal to an earlier one go; documents all of whose lines go stay with the empty text."""
    cut = lines.dedup_lines(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-equal texts stays."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of all words, by target weights; no document is taken twice."""
    return mixing.mix(docs.select(*COLUMNS), mix_levels(), WEIGHTS, budget_share=0.8, max_epochs=1, seed=17)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in sequences of 2048."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_duplicates),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizing and the trained classifier are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
