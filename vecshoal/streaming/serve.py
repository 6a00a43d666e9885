"""Answering queries as they arrive."""

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vecshoal.session import materialise, remove_path


def answer_stream(
    queries: DataFrame,
    answer: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
    path: str,
    checkpoint: str,
    once: bool = False,
    refused: str | None = None,
) -> StreamingQuery:
    """Run ``answer`` on every micro-batch of a stream of queries and store what it returns.

    An ``answer`` that returns two tables, such as :func:`vecshoal.plans.text.search_text`, gives the refused queries with the second,
    which goes to the folder ``refused``. The batch is stored first, so that both tables come from the same rows.
    A batch that is run again after a failure overwrites its own folders, so answers are stored
    once. ``once`` answers what is there and stops.
    """

    def store(batch: DataFrame, number: int) -> None:
        if refused is None:
            answer(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")
            return
        kept, folder = materialise(batch, "batch")
        answers, others = answer(kept)
        answers.write.mode("overwrite").parquet(f"{path}/batch={number}")
        others.write.mode("overwrite").parquet(f"{refused}/batch={number}")
        remove_path(batch.sparkSession, folder)

    writer = queries.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
