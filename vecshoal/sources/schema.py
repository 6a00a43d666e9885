"""Table layouts."""

from pyspark.sql import types as T

_vector = T.ArrayType(T.DoubleType())

ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("encd", _vector),
        T.StructField("img_name", T.StringType()),
    ]
)

CLUSTERED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("cluster_centroid", _vector),
        T.StructField("dataset", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("encd", _vector),
        T.StructField("img_name", T.StringType()),
    ]
)

# Clustered items plus the projected vector that search scores.
INDEXED = T.StructType(CLUSTERED.fields + [T.StructField("reduced", _vector)])

# The same with both keys of a two-level index: the mixture's group, and the cluster inside it.
KEYED = T.StructType(
    INDEXED.fields + [T.StructField("gmm_cluster_id", T.IntegerType()), T.StructField("secondary_cluster_id", T.IntegerType())]
)

# Indexed items with a short code of the reduced vector: whole numbers, their scale, and a bound of the error they make.
CODED = T.StructType(
    INDEXED.fields
    + [T.StructField("code", T.BinaryType()), T.StructField("scale", T.DoubleType()), T.StructField("slack", T.DoubleType())]
)

# Column names of older collections and their names in the stored layout.
OLDER_NAMES = {
    "bert_ecd": "encd",
    "kmeans_cluster_id": "cluster_id",
    "kmeans_cluster_centroid": "cluster_centroid",
}
