"""Text queries: check, encode, search, and give addresses."""

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.functions.encode import encode_text
from vecshoal.operators.partials import spread
from vecshoal.operators.search import result_lists, split_queries
from vecshoal.plans.index import SearchIndex


def with_vectors(
    rows: DataFrame, load: Callable[[], object], key: str, text: str = "text", vector: str = "encd"
) -> DataFrame:
    """Add the encoded text as a vector column."""
    return spread(rows, key).withColumn(vector, encode_text(F.col(text), load))


def search_text(
    index: SearchIndex, queries: DataFrame, load: Callable[[], object], k: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Answers to ``(query_id, text)`` as one row per query, and the refused queries."""
    good, refused = split_queries(queries)
    encoded = with_vectors(good, load, "query_id").select("query_id", "encd")
    return result_lists(index.search(encoded, k)), refused
