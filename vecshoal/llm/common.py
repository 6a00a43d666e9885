"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.session import materialise

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Spark deletes a query's shuffle files as soon as it ends, for queries run inside."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffles that made it are freed."""
    with freed_shuffles(df.sparkSession):
        return materialise(df, label)[0]


def whole(text: str | Column) -> Column:
    """A text column whose NULLs are empty texts."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key(text: Column, seed: int = 0) -> Column:
    """64 bits of a text; two seeds give 128."""
    return F.xxhash64(F.lit(seed), text) if seed else F.xxhash64(text)


def kept_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the folder, for :func:`vecshoal.session.remove_path` once the next step is stored."""
    with freed_shuffles(df.sparkSession):
        return materialise(df, label)
