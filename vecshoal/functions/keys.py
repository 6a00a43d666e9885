"""Item keys and addresses."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(dataset: Column, img_name: Column) -> Column:
    """``<dataset>_<img_name>``; NULL when either part is NULL."""
    return F.concat(dataset, F.lit("_"), img_name)


def image_url(img_name: Column, prefix: str, suffix: str = ".jpg") -> Column:
    return F.concat(F.lit(prefix), img_name, F.lit(suffix))
