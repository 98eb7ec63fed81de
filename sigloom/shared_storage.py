"""Where intermediate tables go: the folder every executor sees."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="sigloom-")
    return _LOCAL_FOLDERS[context.applicationId]


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, as file listings give it."""
    system, hadoop_path = _hadoop(spark, path)
    return system.makeQualified(hadoop_path).toString()


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file."""
    system, hadoop_path = _hadoop(spark, path)
    stream = system.create(hadoop_path)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


_SCRATCH = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, so results must be stored by then."""
    outer, _SCRATCH.paths = getattr(_SCRATCH, "paths", None), []
    try:
        yield
    finally:
        for path in _SCRATCH.paths:
            system, hadoop_path = _hadoop(spark, path)
            system.delete(hadoop_path, True)
        _SCRATCH.paths = outer


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4()}"
    if getattr(_SCRATCH, "paths", None) is not None:
        _SCRATCH.paths.append(path)
    return path


#: Spark's own switch: the shuffle files of a query go as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _no_leftovers(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The same rows, read back from a table at ``path``.

    Nothing reads the shuffles of the write again, so their files are deleted when it has ended.
    """
    with _no_leftovers(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder, so that a lost executor costs no recomputation."""
    return stored(df, fresh_path(df.sparkSession, label))


def delete_path(spark: SparkSession, path: str) -> None:
    """For an intermediate table whose rows no later plan reads."""
    system, hadoop_path = _hadoop(spark, path)
    system.delete(hadoop_path, True)


def written_apart(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stores what ``make`` returns and deletes the intermediate tables that it wrote on the way."""
    path = fresh_path(spark, label)
    with scratch(spark):
        return stored(make(), path)
