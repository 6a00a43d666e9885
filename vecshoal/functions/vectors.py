"""Vector columns as native expressions: parsing, shape, and similarity."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_bracketed(text: Column, strict: bool = False) -> Column:
    """``"[0.1, 0.2]"`` to array<double>: first and last character dropped, split on commas.

    A part that is no number becomes a NULL element, or raises when ``strict``.
    """
    parts = F.split(F.substring(text, F.lit(2), F.length(text) - 2), ",")
    if strict:
        return F.transform(parts, lambda part: F.trim(part).cast("double"))
    return F.transform(parts, lambda part: F.trim(part).try_cast("double"))


def parse_json(text: Column) -> Column:
    """JSON array text to array<double>; malformed text gives NULL."""
    return F.from_json(text, "array<double>")


def to_text(vector: Column) -> Column:
    """A vector as JSON text, the form CSV files hold."""
    return F.to_json(vector)


def width(vector: Column) -> Column:
    return F.array_size(vector)


def first_elements(vector: Column, n: int) -> Column:
    return F.slice(vector, 1, n)


def element_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, x: total + x)


def wide_columns(df: DataFrame, vector: str, count: int, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """The first ``count`` elements as columns ``<vector>_0 .. <vector>_<count-1>``."""
    return df.select(*keep, *[F.get(vector, F.lit(i)).alias(f"{vector}_{i}") for i in range(count)])


def literal(values) -> Column:
    """A Python sequence as a constant array<double>."""
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a: Column, b: Column) -> Column:
    return element_sum(F.zip_with(a, b, lambda x, y: x * y))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def squared_distance(a: Column, b: Column) -> Column:
    return element_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either side is the zero vector, NULL when either is NULL."""
    lengths = norm(a) * norm(b)
    ratio = F.coalesce(dot(a, b) / F.nullif(lengths, F.lit(0.0)), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), ratio)
