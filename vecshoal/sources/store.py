"""Writing items: append, upsert, truncate, CSV export and CSV ingest.

A stored table is a set of data files and a list of files for each version. A change writes new files beside
those being read, then the list of the next version, which carries over the files that did not change. Readers never
see half a change, and a failed job leaves the last good version in place. Of two writers that
start from the same version one fails.
"""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from vecshoal.functions import vectors
from vecshoal.operators.joins import local_copy
from vecshoal.session import file_system, materialise, remove_path
from vecshoal.sources.items import read_csv_items, split_valid, stored_layout, with_keys

# Up to this many incoming ids are sent to every task that filters the stored rows.
REPLACED_IDS = 500_000
# Up to this many ids are looked up by the files' Bloom filters.
LISTED_IDS = 1_000


class LostRace(RuntimeError):
    """Another writer changed the table meanwhile."""


class ItemTable:
    """A versioned Parquet table, split by ``partition``, one column or several, so that one cluster can be read alone.

    Files are sorted by ``key`` and carry a Bloom filter on it, so that looking up a few ids skips
    nearly all of the vectors.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition: str | tuple[str, ...] | None = "cluster_id",
        key: str = "id",
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition = [partition] if isinstance(partition, str) else list(partition or ())
        self.key = key

    def _numbers(self) -> list[int]:
        """Numbers of all lists, finished or not."""
        fs, root = file_system(self.spark, f"{self.path}/versions")
        return sorted(int(entry.getPath().getName()) for entry in fs.listStatus(root)) if fs.exists(root) else []

    def files(self, version: int | None = None) -> list[str] | None:
        """Data files of a version (default: the current one), below the folder ``data``; None if it was never finished."""
        if version is None:
            versions = self.versions(1)
            return self.files(versions[0]) if versions else []
        fs, path = file_system(self.spark, f"{self.path}/versions/{version}")
        stream = fs.open(path)
        try:
            lines = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
        finally:
            stream.close()
        return lines[:-1] if lines[-1] == "end" else None

    def versions(self, last: int | None = None) -> list[int]:
        """Numbers of the finished versions, or of the ``last`` of them."""
        found = []
        for number in reversed(self._numbers()):
            if len(found) == last:
                break
            if self.files(number) is not None:
                found.append(number)
        return found[::-1]

    def read(self) -> DataFrame:
        return self._read(self.files()).select(*self.schema.names)

    def _read(self, files: list[str]) -> DataFrame:
        """The rows of some files, with the folder names of batches and the metadata of files still to be had."""
        if not files:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{file}" for file in files])

    def replace(self, rows: DataFrame, arranged: bool = False) -> int:
        """Store ``rows`` as the next version; ``arranged`` rows are written as they come."""
        last = self._last()
        rows = rows.select(*self.schema.names)
        return self._commit(last, self._write(rows if arranged else self._arranged(rows)))

    def append(self, rows: DataFrame) -> int:
        """Add rows, without looking at their ids."""
        last, files = self._last(), self.files()
        return self._commit(last, files + self._write(self._arranged(rows.select(*self.schema.names))))

    def upsert(self, incoming: DataFrame, order: list[str] | None) -> int:
        """Insert rows, replacing stored rows of the same id; the last row of a batch wins.

        ``order`` names the columns that tell which of two incoming rows is later; None states
        that no id comes twice. Rows without an id are set aside, and the rest goes on. Only files that hold a
        replaced id are written again; to find them the ids alone are read.
        """
        key = self.key
        last, files = self._last(), self.files()
        self.set_aside(incoming.where(F.col(key).isNull()))
        incoming = incoming.where(F.col(key).isNotNull())
        latest = incoming if order is None else last_wins(incoming, order, key)
        # Read several times below, and to be the same rows each time.
        latest, path = materialise(latest.select(*self.schema.names), "incoming")
        ids = local_copy(latest.select(key), REPLACED_IDS)
        stored = self._read(files)
        if files:
            found = stored.select(key, F.col("_metadata.file_path").alias("file"))
            if ids is not None and (few := ids.limit(LISTED_IDS + 1).toArrow()).num_rows <= LISTED_IDS:
                found = found.where(F.col(key).isin(few.column(0).to_pylist()))
            elif ids is not None:
                found = found.join(F.broadcast(ids), key, "left_semi")
            else:
                found = found.join(latest.select(key), key, "left_semi")
            touched = {row.file.rpartition("/data/")[2] for row in found.select("file").distinct().collect()}
        else:
            touched = set()
        replaced = [file for file in files if file in touched]
        rest = self._read(replaced)
        rest = rest.join(F.broadcast(ids) if ids is not None else latest.select(key), key, "left_anti")
        rows = rest.select(*self.schema.names).unionByName(latest) if replaced else latest
        version = self._commit(last, [file for file in files if file not in touched] + self._write(self._arranged(rows)))
        remove_path(self.spark, path)
        return version

    def set_aside(self, rows: DataFrame) -> None:
        """Keep rows that cannot be stored, apart from the versions; columns that they lack are NULL."""
        if not rows.isEmpty():
            kept = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            rows.select(*kept).write.mode("append").parquet(f"{self.path}/rejected")

    def rejected(self) -> DataFrame:
        """Rows that were set aside."""
        fs, folder = file_system(self.spark, f"{self.path}/rejected")
        if not fs.exists(folder):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rejected")

    def truncate(self) -> int:
        """Remove all rows and say how many there were."""
        last = self._last()
        removed = self.read().count()
        self._commit(last, [])
        return removed

    def drop_old(self, keep: int = 2) -> list[int]:
        """Delete all but the last ``keep`` versions, with the files only they hold, and say which; readers of those must be done."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        needed = {file for version in kept for file in self.files(version)}
        unused = {file for version in old for file in self.files(version)} - needed
        for version in old:
            remove_path(self.spark, f"{self.path}/versions/{version}")
        for file in sorted(unused):
            remove_path(self.spark, f"{self.path}/data/{file}")
        return old

    def _arranged(self, rows: DataFrame) -> DataFrame:
        """Rows of a cluster gathered into few files, a large cluster split over many tasks."""
        return rows.hint("rebalance", *self.partition) if self.partition else rows

    def _last(self) -> int:
        return (self._numbers() or [0])[-1]

    def _commit(self, last: int, files: list[str]) -> int:
        """Make ``files`` the version after ``last``; fails if another writer has made it."""
        fs, path = file_system(self.spark, f"{self.path}/versions/{last + 1}")
        try:
            stream = fs.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                raise LostRace(f"version {last + 1} of {self.path} was written meanwhile") from None
            raise
        try:
            self.spark._jvm.org.apache.commons.io.IOUtils.write("\n".join([*files, "end"]), stream, "UTF-8")
        finally:
            stream.close()
        return last + 1

    def _write(self, rows: DataFrame) -> list[str]:
        """Write a batch of rows to files of their own and list these."""
        batch = f"batch={uuid.uuid4().hex}"
        # Writing by cluster sorts by it anyway.
        rows = rows.sortWithinPartitions(*self.partition, self.key)
        writer = rows.write.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        if self.partition:
            writer = writer.partitionBy(*self.partition)
        writer.parquet(f"{self.path}/data/{batch}")
        fs, folder = file_system(self.spark, f"{self.path}/data/{batch}")
        found, listed = fs.listFiles(folder, True), []
        while found.hasNext():
            path = found.next().getPath().toString()
            if path.endswith(".parquet"):
                listed.append(path.rpartition("/data/")[2])
        return sorted(listed)


def last_wins(rows: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """The latest row of every id.

    ``rank = 1`` lets Spark drop all but one row per id and task before the shuffle, so an id
    that makes up much of the batch costs its reducer one row per task.
    """
    latest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(latest_first)).where("_rank = 1").drop("_rank")


def export_csv(items: DataFrame, path: str) -> None:
    """Items as CSV with a header; array columns are written as JSON text."""
    arrays = [f.name for f in items.schema.fields if isinstance(f.dataType, T.ArrayType)]
    flat = items.withColumns({name: vectors.to_text(F.col(name)) for name in arrays})
    flat.write.option("header", True).option("escape", '"').csv(path)


class RejectedRows(ValueError):
    pass


def ingest_csv(
    table: ItemTable,
    path: str,
    width: int,
    dataset: str = "images",
    form: str = "json",
    on_error: str = "reject",
) -> DataFrame:
    """Read CSV items, add keys, parse vectors, keep the stored fields and upsert them.

    The last line of an id wins. Returns the rejected rows with their reason;
    ``on_error="fail"`` stores nothing when any row is bad.
    """
    parsed = with_keys(read_csv_items(table.spark, path, form=form), dataset)
    good, bad = split_valid(parsed, width, text="encd_text")
    if on_error == "fail" and not bad.isEmpty():
        raise RejectedRows(f"rows of {path} cannot be stored")
    table.upsert(stored_layout(last_wins(good, ["line"])), None)
    return bad.select("id", "img_name", F.col("encd_text").alias("encd"), "reason")
