"""Tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}
# What to remove when each job that is under way ends, the innermost job last.
_jobs: list[list[Callable[[SparkSession], None]]] = []


def shared_folder(spark: SparkSession) -> str:
    """Return the folder named by ``spark.checkpoint.dir``.

    Only a session that runs in one local process may leave the setting out; it then gets a
    temporary folder of its own.
    """
    configured = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SHARED_FOLDER_SETTING} to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tillcube-")
    return _local_folders[application]


def new_path(spark: SparkSession, label: str) -> str:
    """Return a path in the shared folder that no other job uses. Inside :func:`job` it is removed when the job ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _jobs:
        _jobs[-1].append(lambda spark: delete(spark, path))
    return path


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Remove what is written to the shared folder inside the block, whether it ends well or not.

    For jobs that write their results elsewhere: tables that lie on what is removed cannot be read afterwards.
    """
    _jobs.append([])
    try:
        yield
    finally:
        for remove in _jobs.pop():
            remove(spark)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of it.

    The scan has a short lineage, survives the loss of executors, is pruned by column, and its
    size is known to the optimizer, which then decides by size whether a join may broadcast it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by_key(df: DataFrame, label: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table in buckets of ``key`` and return it.

    Rows are dealt out by the key once; groupings and joins by the key (and more columns) then need no shuffle, as
    often as the table is read. For tables in which no key holds a large share of the rows, such as sums.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(count, key)
    dealt.write.format("parquet").bucketBy(count, key).sortBy(key).option("path", path).saveAsTable(name)
    if _jobs:
        _jobs[-1].append(lambda spark: spark.sql(f"drop table if exists {name}"))
    return spark.table(name)


def _opened(spark: SparkSession, path: str):
    """The file system of a path, whatever its kind, and the path in it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens where there is none."""
    system, there = _opened(spark, path)
    system.delete(there, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    system, there = _opened(spark, path)
    return [found.getPath().getName() for found in system.listStatus(there)] if system.exists(there) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, there = _opened(spark, path)
    stream = system.create(there, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text, None where there is none."""
    system, there = _opened(spark, path)
    if not system.exists(there):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Put a file in the place of another."""
    system, there = _opened(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if not system.rename(there, target):
        # Some file systems do not rename onto a file that is there.
        system.delete(target, False)
        if not system.rename(there, target):
            raise OSError(f"cannot put {path} in the place of {to}")
