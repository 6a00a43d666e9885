"""Joining a large table to one that is usually small."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 64 << 20


def local_copy(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``small`` as a local relation when its rows and bytes stay within the bounds, else None."""
    head = small.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows or head.nbytes > max_bytes:
        return None
    return small.sparkSession.createDataFrame(head, small.schema)


def attach(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread: str,
    salts: int = 256,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join on ``key``: by broadcast when ``small`` is measured to fit, else by salted shuffle.

    The salt comes from the column ``spread`` of the large side, so a key that holds a third
    of its rows is shared among ``salts`` reducers.
    """
    fits = local_copy(small, max_rows)
    if fits is not None:
        return large.join(F.broadcast(fits), key)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")
