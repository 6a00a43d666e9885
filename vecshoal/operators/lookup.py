"""Rows by id, by list of ids, by cluster, or by predicate."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_id(items: DataFrame, item_id: str) -> DataFrame:
    return items.where(F.col("id") == item_id)


def by_ids(items: DataFrame, ids: list[str]) -> DataFrame:
    """Rows whose id is in a list; an empty list gives no rows."""
    return items.where(F.col("id").isin(list(ids)))


def by_id_table(items: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id occurs in a table of ids, which may be large and may repeat an id."""
    return items.join(ids.select(key).distinct(), key, "left_semi")


def by_cluster(items: DataFrame, cluster_id: int, column: str = "cluster_id") -> DataFrame:
    """Rows of one cluster or label; only that folder is read when the table is split by it."""
    return items.where(F.col(column) == cluster_id)


def matching(items: DataFrame, query: Column | str | dict) -> DataFrame:
    """Rows that satisfy a Column, a SQL predicate, or all ``{field: value}`` equalities."""
    if not isinstance(query, dict):
        return items.where(query)
    tests = [F.col(name).eqNullSafe(F.lit(value)) for name, value in query.items()]
    return items.where(reduce(lambda a, b: a & b, tests, F.lit(True)))
