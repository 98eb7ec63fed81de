"""The table of what to publish: every instance on every line, repeated as often as the target asks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import instances as inst
from sigloom.functions import paths
from sigloom.functions.segments import whole_division
from sigloom.operators.joins import broadcast_if_small
from sigloom.operators.numbering import MAX_ROWS_PER_TASK, number_rows

ITEM_ORDER = ["event_time", "line_id", "product_instance_id"]
INSTANCE_ORDER = ["event_time", "line_id", "instance_id"]


def seeded_order(instances: DataFrame, seeds: Sequence[int], lines: int, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """The instances once per line, with their ``slot`` in that line's own order.

    The order is by a hash of seed and id: the same for the same seed, whatever the partitioning. Seeds are reused
    in turn when there are fewer than lines.
    """
    line_seeds = F.array(*[F.lit(int(s)).cast("bigint") for s in seeds])
    seed = F.element_at(line_seeds, (F.col("line_index") % len(seeds) + 1).cast("int"))
    shuffled = instances.withColumn(
        "line_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lines - 1).cast("bigint")))
    ).withColumn("__rank", F.md5(F.concat_ws(":", seed.cast("string"), F.col("instance_id")).cast("binary")))
    return number_rows(
        shuffled, ["line_index"], ["__rank", "instance_id"], max_rows, pos="slot", total="__n"
    ).drop("__rank", "__n")


def replay_items(
    instances: DataFrame,
    lines: int = 1,
    target: int = 0,
    max_products: int | None = None,
    interval_seconds: float = fixed.LINE_INTERVAL_SECONDS,
    seeds: Sequence[int] | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Publish items: item ``i`` goes to line ``i % lines`` as that line's product number ``i div lines``.

    Products start over when a line runs out of them. Repeats, and instances moved to another line, get an id of
    their own and are marked. Times count from the first instance, one interval per product number.
    """
    spark = instances.sparkSession
    if max_products:
        instances = instances.orderBy(*INSTANCE_ORDER).limit(max_products)
    facts = instances.agg(F.count("*").alias("n"), F.min("event_time").alias("first")).first()
    count = facts["n"]
    if count and lines < 1:
        raise ValueError("lines must be >= 1")
    lines = max(lines, 1)
    total = 0 if count == 0 else target if target > 0 else count * lines
    if seeds:
        pool, slots = seeded_order(instances, seeds, lines, max_rows), ["line_index", "slot"]
    else:
        pool, slots = number_rows(instances, [], INSTANCE_ORDER, max_rows, pos="slot", total="__n").drop("__n"), ["slot"]

    product = F.col("product_index")
    items = (
        spark.range(total)
        .select(
            F.pmod("id", F.lit(lines)).cast("bigint").alias("line_index"),
            whole_division(F.col("id"), lines).alias("product_index"),
        )
        .withColumn("slot", product % F.lit(max(count, 1)).cast("bigint"))
        .join(broadcast_if_small(pool, count * (lines if seeds else 1)), slots)
    )
    item_line = F.col("line_id") if lines == 1 else paths.line_id(F.col("line_index") + 1)
    number = inst.line_number(F.col("line_id")) if lines == 1 else (F.col("line_index") + 1).cast("int")
    repeat = whole_division(product, max(count, 1))
    replayed = (repeat > 0) | (item_line != F.col("line_id"))
    replay_id = F.format_string(fixed.REPLAY_ID_FORMAT, F.col("instance_id"), item_line, repeat)
    step = F.make_dt_interval(secs=(product * F.lit(interval_seconds)).cast("decimal(18,6)"))
    return items.select(
        F.when(replayed, replay_id).otherwise(F.col("instance_id")).alias("product_instance_id"),
        F.col("instance_id").alias("original_product_instance_id"),
        "product_id",
        "batch_id",
        "sequence_id",
        item_line.alias("line_id"),
        number.alias("line_number"),
        (F.lit(facts["first"]).cast("timestamp") + step).alias("event_time"),
        replayed.alias("is_duplicate"),
        repeat.cast("int").alias("replay_iteration"),
    )


def in_publish_order(items: DataFrame) -> DataFrame:
    """Final order for a report or a file; publishing itself does not need it."""
    return items.orderBy(*ITEM_ORDER)


def dry_run_summary(items: DataFrame) -> DataFrame:
    """One row: items, originals, duplicates and the lines in use. Lines are few by nature."""
    return items.agg(
        F.count("*").alias("product_instances"),
        F.count_if(~F.col("is_duplicate")).alias("originals"),
        F.count_if("is_duplicate").alias("duplicates"),
        F.array_join(F.array_sort(F.collect_set("line_id")), ", ").alias("lines"),
    )
