"""Reading items from Parquet and CSV, and checking them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshoal.functions import keys, vectors
from vecshoal.sources.schema import CLUSTERED, ITEM, OLDER_NAMES


def read_items(spark: SparkSession, path: str, schema: T.StructType = ITEM) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def first_items(items: DataFrame, n: int = 1, order: str = "id") -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return items.orderBy(order).limit(n)


def read_csv_items(spark: SparkSession, path: str, vector: str = "encd", form: str = "json") -> DataFrame:
    """CSV with a header; every column text but the vector, which is parsed.

    ``form`` says how the vector is written: ``json`` or ``bracketed``. The unparsed text
    stays in ``<vector>_text`` so that rejected rows can be shown as they came. ``line`` orders
    rows as the file does: by the start of their split, and inside it by the running row number.
    """
    parse = {"json": vectors.parse_json, "bracketed": vectors.parse_bracketed}[form]
    raw = csv_rows(spark, path)
    line = F.struct(
        "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")
    )
    lines = raw.select("*", line.alias("line"), F.col(vector).alias(f"{vector}_text"))
    return lines.withColumn(vector, parse(F.col(vector)))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files under ``path``, columns matched by the names in each file's header, not by place.

    Files are read together by the header they have. A column that a file lacks is NULL for its rows.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("header"))
    # One row per layout: as many as there are different headers.
    layouts = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if len(layouts) <= 1:
        return spark.read.option("header", True).option("escape", '"').csv(path)
    parts = [spark.read.option("header", True).option("escape", '"').csv(sorted(layout.files)) for layout in sorted(layouts)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def with_keys(rows: DataFrame, dataset: str = "images") -> DataFrame:
    """Add the constant ``dataset`` and the ``id`` made from it and ``img_name``."""
    return rows.withColumn("dataset", F.lit(dataset)).withColumn(
        "id", keys.item_id(F.col("dataset"), F.col("img_name"))
    )


def modern_names(rows: DataFrame) -> DataFrame:
    """Rename the columns of older collections to the stored layout."""
    return rows.withColumnsRenamed(OLDER_NAMES)


def stored_layout(rows: DataFrame) -> DataFrame:
    """Project to the stored layout: five fields, or seven once the rows are clustered."""
    rows = modern_names(rows)
    layout = CLUSTERED if "cluster_id" in rows.columns else ITEM
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields])


def items_from_vectors(
    rows: DataFrame, key: str, vector: str, url_prefix: str, dataset: str = "images", label: str | None = None
) -> DataFrame:
    """Items from a table that has only a numeric key and a vector.

    ``label`` names a column that already says which cluster a row belongs to.
    """
    named = with_keys(rows.withColumn("img_name", F.lpad(F.col(key).cast("string"), 12, "0")), dataset)
    out = [
        F.col("id"),
        F.col("dataset"),
        keys.image_url(F.col("img_name"), url_prefix).alias("url"),
        F.col(vector).cast("array<double>").alias("encd"),
        F.col("img_name"),
    ]
    if label is not None:
        out.append(F.col(label).cast("int").alias("cluster_id"))
    return named.select(*out)


def defect(width: int, vector: str = "encd", key: str = "id", text: str | None = None) -> Column:
    """Why a row cannot be stored, or NULL when it can; ``text`` is what the vector was parsed from."""
    v = F.col(vector)
    unread = F.col(text).isNotNull() if text else F.lit(False)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.when(F.col(key).isNull(), "missing id")
        .when(v.isNull() & unread, "unreadable vector")
        .when(v.isNull(), "missing vector")
        .when(F.array_size(v) != width, "wrong width")
        .when(broken, "not a number")
    )


def split_valid(
    rows: DataFrame, width: int, vector: str = "encd", key: str = "id", text: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored, and the others with a ``reason``."""
    marked = rows.withColumn("reason", defect(width, vector, key, text))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
