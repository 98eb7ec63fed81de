"""Signal files -> product instances -> keyed chunk messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import paths
from sigloom.operators import instances as ops
from sigloom.operators.chunks import chunk_samples
from sigloom.operators.joins import broadcast_if_small
from sigloom.operators.dates import on_oldest_date
from sigloom.operators.messages import build_messages
from sigloom.operators.replay import dry_run_summary, replay_items
from sigloom.shared_storage import qualified_path, scratch, written
from sigloom.sources.files import FileChoice, SignalFiles, list_files


class InstanceScan:
    """The product instances of a tree. The listing is parsed once and kept as a table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        relative = paths.below(F.col("path"), qualified_path(spark, root))
        listed = list_files(spark, root).select(F.col("source_file").alias("path"))
        self.parsed = written(ops.parse_instances(listed, relative), "listing")

    @property
    def ignored(self) -> DataFrame:
        """Files whose name and folders say too little, and files with an impossible date."""
        reason = F.when(F.col("instance_id").isNull(), "not a signal file name").when(
            F.col("event_time").isNull(), "impossible date or time"
        )
        return self.parsed.select("path", reason.alias("reason")).filter("reason IS NOT NULL")

    @property
    def files(self) -> DataFrame:
        return self.parsed.filter("instance_id IS NOT NULL AND event_time IS NOT NULL")

    @property
    def pairs(self) -> DataFrame:
        return ops.lead_pairs(self.files)

    def instances(self, only_complete: bool = False, oldest_date_only: bool = False) -> DataFrame:
        found = ops.product_instances(self.files)
        if only_complete:
            found = ops.only_complete(found, self.pairs)
        if oldest_date_only:
            found = on_oldest_date(found, F.to_date("event_time"))
        return found


def plan_items(
    scan: InstanceScan,
    only_complete: bool = False,
    oldest_date_only: bool = False,
    lines: int = 1,
    target: int = 0,
    max_products: int | None = None,
    interval_seconds: float = fixed.LINE_INTERVAL_SECONDS,
    seeds: Sequence[int] | None = None,
) -> DataFrame:
    """What would be published: the dry run."""
    chosen = written(scan.instances(only_complete, oldest_date_only), "instances")
    return replay_items(chosen, lines, target, max_products, interval_seconds, seeds)


#: Dates that a scan is pruned by at most; items of one file that one task joins.
PRUNING_DATES = 1_000
ITEMS_PER_TASK = 10_000


def _choice(published_paths: DataFrame) -> FileChoice:
    """The dates of the files to publish, so that the scan leaves out all others; everything where a path has none."""
    days = published_paths.select(paths.event_date(F.col("path")).alias("day")).distinct().limit(PRUNING_DATES + 1).collect()
    dates = [r.day for r in days]
    return FileChoice() if None in dates or len(dates) > PRUNING_DATES else FileChoice(event_dates=tuple(sorted(dates)))


def plan_messages(scan: InstanceScan, items: DataFrame, chunk_size: int = fixed.CHUNK_SIZE) -> DataFrame:
    """All messages of the items. A file is read and cut once, however often its instance is replayed.

    Only files of the dates that are published are scanned. Items of a file that is replayed very often are spread over
    tasks, each of which gets the file's chunks.
    """
    files = ops.signal_files(scan.pairs).withColumnRenamed("instance_id", "original_product_instance_id")
    wanted = written(items.join(files, "original_product_instance_id"), "wanted")
    source = SignalFiles(scan.spark, scan.root, _choice(wanted.select("path").distinct()), single_precision=True)
    signals = source.signals.select("file_id", F.col("source_file").alias("path"))
    published = written(wanted.join(signals, "path"), "published")
    # Samples of files that nobody publishes go before they are shuffled into chunks.
    uses = written(published.groupBy("file_id").count(), "uses")
    facts = uses.agg(F.count("*").alias("files"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.max("count").alias("most")).first()
    used = broadcast_if_small(uses.select("file_id"), facts["files"], 64)
    chunks = chunk_samples(source.samples.join(used, "file_id", "left_semi"), ["file_id"], chunk_size)
    spread = -(-(facts["most"] or 0) // ITEMS_PER_TASK)
    key = ["file_id"]
    if spread > 1:
        part = F.pmod(F.hash("product_instance_id"), F.lit(spread))
        published, key = published.withColumn("__part", part), ["file_id", "__part"]
        chunks = chunks.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    joined = chunks.join(broadcast_if_small(published, facts["rows"], 1024), key).drop("__part")
    return build_messages(joined.withColumn("file_name", paths.file_name(F.col("path"))))


@dataclass(frozen=True)
class PublishResult:
    """What a run publishes, or would publish."""

    product_instances: int
    originals: int
    duplicates: int
    lines: str

    def report(self) -> list[str]:
        return [f"{name}: {value}" for name, value in vars(self).items()]


def run_publish(
    spark: SparkSession,
    root: str,
    send: Callable[[DataFrame], None] | None = None,
    chunk_size: int = fixed.CHUNK_SIZE,
    **plan,
) -> PublishResult:
    """Plan the items of a tree (``plan``: see ``plan_items``) and hand all their messages to ``send``, once and as a
    DataFrame. Without ``send`` it is a dry run; without items nothing is sent. Intermediate tables are deleted.
    """
    with scratch(spark):
        scan = InstanceScan(spark, root)
        items = written(plan_items(scan, **plan), "items")
        result = PublishResult(**dry_run_summary(items).first().asDict())
        if send is not None and result.product_instances:
            send(plan_messages(scan, items, chunk_size))
        return result
