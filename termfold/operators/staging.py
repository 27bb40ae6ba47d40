"""Small results that several later steps need: written once, measured, read back."""

from __future__ import annotations

import tempfile
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 64

_local: list[str] = []
_folders: set[str] = set()
# Tables that ``staged`` wrote in this thread, in order, until ``release`` deletes them.
_written = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only a local master may do without the setting: its executors are the driver.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="termfold-"))
    return _local[0]


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects, wherever the path points to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession) -> str:
    """A place for one table in the application's own folder, which goes when the application ends."""
    folder = f"{shared_folder(spark)}/termfold-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        fs, at = file_system(spark, folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _folders.add(folder)
    return f"{folder}/{uuid.uuid4().hex}"


def _staged_paths() -> list[str]:
    if not hasattr(_written, "paths"):
        _written.paths = []
    return _written.paths


def staged(df: DataFrame) -> DataFrame:
    """The same rows from a written table: no lineage, and repeated use costs a scan."""
    spark, path = df.sparkSession, new_path(df.sparkSession)
    df.write.parquet(path)
    _staged_paths().append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """The place in this thread's staged tables from which ``release`` deletes them."""
    return len(_staged_paths())


def release(spark: SparkSession, since: int, keep: tuple[DataFrame, ...] = ()) -> None:
    """Deletes the tables this thread staged after ``since``, but those that a DataFrame of ``keep`` reads.

    Staged tables otherwise stay until the application ends; a chain of steps calls this once a step's result is
    written, so that its intermediate tables and the step before's result do not pile up on disk.
    """
    paths = _staged_paths()
    read = [f for df in keep for f in df.inputFiles()]
    kept = []
    for path in paths[since:]:
        name = path.rsplit("/", 1)[-1]
        if any(f"/{name}/" in f or f.endswith(f"/{name}") for f in read):
            kept.append(path)
        else:
            fs, at = file_system(spark, path)
            fs.delete(at, True)
    paths[since:] = kept


def staged_and_measured(df: DataFrame, counted: str | None = None) -> tuple[DataFrame, Size]:
    """A staged table and its size, counted while it is written."""
    seen = Observation()
    table = staged(df.observe(seen, *[c.alias(n) for c, n in zip(_sizes(df, counted), ("rows", "bytes", "total"))]))
    got = seen.get
    return table, Size(got["rows"], got["bytes"], got["total"])


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int
    total: int          # sum of the counted column

    @property
    def broadcastable(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def measure(table: DataFrame, counted: str | None = None) -> Size:
    """Rows and bytes of a staged table, and the sum of one of its columns."""
    return Size(*table.agg(*_sizes(table, counted)).first())


def _sizes(table: DataFrame, counted: str | None) -> list[Column]:
    width = F.lit(ROW_OVERHEAD)
    for f in table.schema.fields:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width = width + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0))
    total = F.sum(counted) if counted else F.sum(F.lit(0))
    return [F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)), F.coalesce(total, F.lit(0))]
