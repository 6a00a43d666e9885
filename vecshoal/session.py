"""Session settings and the shared scratch folder."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_roots: dict[str, str] = {}


def local_session(cores: str = "*", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vecshoal")
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder. A folder on
    one machine would be lost with it, so a cluster session without the setting is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="vecshoal-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/vecshoal/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of its splits, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A model table, whose size does not grow with the data, as a local relation of known size."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame(pa.table([list(column) for column in zip(*rows)], names=names), schema)


def write_small(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    small_table(spark, rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path objects for ``path``, whatever store it lives in."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)
