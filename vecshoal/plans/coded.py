"""A search index whose items also carry short codes of their reduced vectors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecshoal.operators import codes, search
from vecshoal.plans.index import SearchIndex
from vecshoal.session import materialise
from vecshoal.sources.schema import CODED


class CodedIndex(SearchIndex):
    """Answers are those of :class:`SearchIndex`; of a cluster the codes are read, and vectors only where the codes leave a doubt."""

    schema = CODED

    def _labelled(self, items: DataFrame, arranged: bool = False) -> DataFrame:
        return codes.with_codes(super()._labelled(items, arranged), "reduced", self.model.features.kept)

    def _asked(self, queries: DataFrame) -> DataFrame:
        good, _ = search.split_vector_queries(queries, self.model.features.width)
        return self.model.place(good)

    def search(self, queries: DataFrame, k: int = 20, space: str = "reduced", keep=search.ITEM_COLUMNS) -> DataFrame:
        if space != "reduced":
            return super().search(queries, k, space, keep)
        return codes.top_k_coded(self.table.read(), self._asked(queries), k, "reduced", self.model.features.kept, keep, checked=True)

    def candidates(self, queries: DataFrame, k: int = 20, exact: bool = False, within: float | None = None) -> DataFrame:
        """``query_id, id, lower, upper``: the items whose vectors a search would read, and the bounds of their similarity.

        With ``exact`` also the ``cluster_id`` and the ``similarity`` by the vectors, which are then read. With ``within`` these pairs are counted where they
        are made: rows of ``cluster_id, pairs, held`` to be added up, ``held`` being those whose similarity lies between bounds less than ``within`` apart.
        """
        exact = exact or within is not None
        width = self.model.features.kept
        asked = self._asked(queries).select("query_id", "cluster_id", F.col("reduced").alias("vector"))
        most = codes.most_queries(k, width)
        head = asked.limit(most + 1).toArrow()
        if exact or head.num_rows > most:
            asked, _ = materialise(asked, "queries")
            found = codes.candidates_dealt(self.table.read(), asked, k, width, "reduced" if exact else None, within)
            return found if exact else found.drop("cluster_id")
        found = codes.candidates(self.table.read(), head, k, width)
        numbered = head.select(["query_id"]).append_column("query", [list(range(head.num_rows))])
        return found.join(F.broadcast(self.spark.createDataFrame(numbered)), "query").drop("query")
