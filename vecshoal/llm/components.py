"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import kept_at
from vecshoal.session import remove_path


def components(links: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``(a, b)`` for every end of a link but the least of its component: ``b`` is that least end. Also the folder it is stored in.

    Each round lets every node point its larger neighbours, then its smaller ones, to the least end it knows; the number
    of rounds grows with the logarithm of a component's size. A round is stored before the next one. The join of a node's links to
    its least neighbour has one row on one side, so Spark can split the links of a node that has many.
    """
    spark = links.sparkSession
    now, path = kept_at(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    mark = checksum(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        first = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(first, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(first.withColumnRenamed("m", "b")).distinct()
        after, after_path = kept_at(small, label)
        remove_path(spark, path)
        after_mark = checksum(after)
        now, path = after, after_path
        if after_mark == mark:
            return now, path
        mark = after_mark


def checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
