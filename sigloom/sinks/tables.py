"""Parquet tables: partitioned appends, and upserts that may be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.operators.joins import attach, broadcast_if_small
from sigloom.operators.upsert import upsert_by_key
from sigloom.shared_storage import path_exists, written

PARTITION_COLUMNS = ["event_date", "line_number"]
TABLES = {
    "segments": (fixed.SEGMENT_COLUMNS, PARTITION_COLUMNS),
    "summary": (fixed.SUMMARY_COLUMNS, PARTITION_COLUMNS),
    "runs": (fixed.RUN_COLUMNS, []),
}


def append_partitioned(df: DataFrame, path: str) -> None:
    """Append by event date and line. Running the same run twice doubles its rows; ``upsert_table`` does not.

    One shuffle by partition value keeps a task from opening a file in every partition; adaptive execution splits
    the partitions that are too large for one task.
    """
    df.hint("rebalance", *PARTITION_COLUMNS).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def create_tables(spark: SparkSession, database: str) -> None:
    """The three result tables in the session's catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, partitions) in TABLES.items():
        fields = ", ".join(f"{column} {kind}" for column, kind in columns.items())
        layout = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({fields}) USING parquet {layout}")


def upsert_table(incoming: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = ("run_id",)) -> None:
    """Replace or add rows by key in the Parquet table at ``path``.

    Partition columns must be keys, so that a row can never move to another partition. Only partitions that receive
    rows are read and rewritten, and the new contents are complete in shared storage before any is replaced. NULL is a
    key value like any other. A key that comes twice in ``incoming`` is an error.
    """
    if not set(partitions) <= set(keys):
        raise ValueError("partition columns must be among the keys")
    spark = incoming.sparkSession
    incoming = written(incoming, "incoming")
    if not incoming.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"rows repeat a key of {', '.join(keys)}")
    merged = incoming
    if path_exists(spark, path):
        existing = spark.read.schema(incoming.schema).parquet(path)
        touched = incoming.select(*partitions).distinct()
        touched = broadcast_if_small(touched, touched.count())
        merged = written(upsert_by_key(attach(existing, touched, partitions, "left_semi"), incoming, keys), "merged")
    (
        merged.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def run_row(
    spark: SparkSession, run_id, status, started_at, finished_at, total_files, segment_rows, summary_rows, output_dir
) -> DataFrame:
    """The one row that describes a run."""
    values = [run_id, status, started_at, finished_at, total_files, segment_rows, summary_rows, output_dir, "{}"]
    columns = [F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, fixed.RUN_COLUMNS.items())]
    return spark.range(1).select(*columns)
