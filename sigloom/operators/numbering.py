"""Positions of rows within their group, for groups of any size.

Rows that tie in the order stand in the order of a hash of all their columns, whichever way they are numbered. A window
is enough while every group fits one task. Groups above ``max_rows`` are sorted across tasks instead: rows
are range-partitioned by (keys, order), numbered inside each partition, and shifted by the sizes of the partitions
before. The sorted rows are written once to shared storage, so that the partition sizes and the rows they shift can
never come from two different sorts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.operators.joins import attach, broadcast_if_small
from sigloom.shared_storage import written

MAX_ROWS_PER_TASK = 1_000_000
#: Inputs that Spark reckons below this can't hold a group too large for a task, so nothing is counted beforehand.
UNCOUNTED_BYTES = 8 * 1024 * 1024


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_ROWS_PER_TASK,
    pos: str = "pos",
    total: str = "n",
) -> DataFrame:
    """Add the 0-based position of each row among the rows with its keys, and how many those are.

    Where the input may hold a group above ``max_rows``, the groups are counted first: one map-side-combined job over
    the key columns that returns one row. Without keys all rows are one group, which is always spread over tasks.
    """
    keys = list(keys)
    if not keys:
        return _number_across_tasks(df, keys, order, None, max_rows, pos, total)
    if max_rows >= MAX_ROWS_PER_TASK and _reckoned_bytes(df) < UNCOUNTED_BYTES:
        return _number_in_task(df, keys, order, pos, total)
    sizes = df.groupBy(*keys).agg(F.count("*").alias(total))
    large = sizes.filter(F.col(total) > max_rows)
    found = large.agg(F.count("*").alias("groups"), F.coalesce(F.sum(total), F.lit(0)).alias("rows")).first()
    if found["groups"] == 0:
        return _number_in_task(df, keys, order, pos, total)
    marked = attach(
        df, broadcast_if_small(large.select(*keys, F.lit(True).alias("__large")), found["groups"]), keys, "left"
    )
    in_large = marked.filter("__large").drop("__large")
    in_small = marked.filter("__large IS NULL").drop("__large")
    return _number_in_task(in_small, keys, order, pos, total).unionByName(
        _number_across_tasks(in_large, keys, order, found["rows"], max_rows, pos, total)
    )


def _reckoned_bytes(df: DataFrame) -> int:
    """The optimizer's own figure; for files their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _ties(df: DataFrame):
    return F.xxhash64(*df.columns)


def _number_in_task(df, keys, order, pos, total):
    group = Window.partitionBy(*keys)
    return df.withColumns(
        {
            pos: (F.row_number().over(group.orderBy(*order, _ties(df))) - 1).cast("bigint"),
            total: F.count("*").over(group),
        }
    )


def _number_across_tasks(df, keys, order, rows, max_rows, pos, total):
    # The hash spreads rows whose order columns tie.
    ordered = [*keys, *order, _ties(df)]
    ranged = df.repartitionByRange(*ordered) if rows is None else df.repartitionByRange(-(-rows // max_rows), *ordered)
    ranged = ranged.sortWithinPartitions(*ordered)
    table = written(
        ranged.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()}), "ranged"
    )
    blocks = table.groupBy(*keys, "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__size"))
    # One row per (group, partition it touches): small, since each group here is large.
    group = Window.partitionBy(*(keys or [F.lit(0)]))  # without keys: one row per partition
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *keys,
        "__part",
        (F.coalesce(F.sum("__size").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__size").over(group).alias(total),
    )
    numbered = attach(table, broadcast_if_small(offsets, blocks.count()), [*keys, "__part"])
    return numbered.withColumn(pos, F.col("__id") + F.col("__shift")).select(*df.columns, pos, total)
