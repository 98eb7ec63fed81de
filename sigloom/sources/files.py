"""Signal files: listing, choosing and reading a tree of CSV files, one row per sample.

A file is read in blocks by many tasks, once: the parsed rows are stored with consecutive ids inside a block. A sample's
position is its id plus an offset that follows from the sizes of the blocks before; samples are neither sorted nor
shuffled to be numbered. Both come from the same stored rows, so it makes no difference how a later scan would be cut.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.functions import paths, values
from sigloom.operators.joins import broadcast_if_small
from sigloom.shared_storage import written

# Bytes of a block in a broadcast table, found by hash or by its path, and what such a table may take in an executor.
HASHED_BLOCK_BYTES = 80
NAMED_BLOCK_BYTES = 512
BLOCK_TABLE_BYTES = 512 * 1024 * 1024


def _tree(spark: SparkSession, kind: str, root: str) -> DataFrame:
    # Case-sensitive, at any depth. Hidden and empty files are not listed.
    reader = spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return reader.load(root)


@dataclass(frozen=True)
class FileChoice:
    """Which files of a tree to use: all, or those up to a path in path order, or those of one event date or a few."""

    last_parts: tuple[str, ...] | None = None
    event_date: date | None = None
    event_dates: tuple[date, ...] | None = None

    def of(self, path: Column, modified: Column) -> Column:
        """The choice as a predicate. On the metadata columns of a scan it prunes whole files."""
        chosen = F.lit(True)
        if self.last_parts is not None:
            chosen = chosen & (paths.path_parts(path) <= F.array(*[F.lit(p) for p in self.last_parts]))
        if self.event_date is not None:
            chosen = chosen & (paths.event_date(path, modified) == F.lit(self.event_date))
        if self.event_dates is not None:
            chosen = chosen & paths.event_date(path, modified).isin(*self.event_dates)
        return chosen


def list_files(spark: SparkSession, root: str, choice: FileChoice = FileChoice()) -> DataFrame:
    """One row per file: ``source_file``, ``modified``, ``bytes``. Contents are not read."""
    path, modified = paths.plain_path(F.col("_metadata.file_path")), F.col("_metadata.file_modification_time")
    return (
        _tree(spark, "binaryFile", root)
        .filter(choice.of(path, modified))
        .select(path.alias("source_file"), modified.alias("modified"), F.col("_metadata.file_size").alias("bytes"))
    )


def choose_files(spark: SparkSession, root: str, max_files: int = 0, oldest_date_only: bool = False) -> FileChoice:
    """First the cap in path order, then the oldest date among those. Each is settled by one looked-up value."""
    choice = FileChoice()
    if max_files > 0:
        capped = list_files(spark, root).select(paths.path_parts(F.col("source_file")).alias("parts"))
        last = capped.orderBy("parts").limit(max_files).agg(F.max("parts").alias("parts")).first()["parts"]
        choice = FileChoice(last_parts=None if last is None else tuple(last))
    if oldest_date_only:
        day = paths.event_date(F.col("source_file"), F.col("modified"))
        oldest = list_files(spark, root, choice).agg(F.min(day).alias("d")).first()["d"]
        choice = FileChoice(last_parts=choice.last_parts, event_date=oldest)
    return choice


class SignalFiles:
    """A tree of signal files as DataFrames: ``files``, ``signals``, ``samples`` and ``skipped``.

    Samples name their file by ``file_id``; ``signals`` holds what belongs to an id. Paths join results once those are
    aggregated, so they are not carried along with every sample.
    """

    def __init__(
        self, spark: SparkSession, root: str, choice: FileChoice = FileChoice(), single_precision: bool = False
    ):
        self.single_precision = single_precision
        self.choice = choice
        self.files = list_files(spark, root, choice)
        # One scan object, so that every pass over the text sees the same listing and the same blocks.
        self._scan = _tree(spark, "text", root)

    def _lines(self) -> DataFrame:
        """Samples and undecodable lines, with ids that are consecutive within a block.

        The line counter in the filter is always true. It keeps the filter above the parsing; pushed below, every line
        would be parsed once more for the filter.
        """
        path, modified = paths.plain_path(F.col("_metadata.file_path")), F.col("_metadata.file_modification_time")
        parsed = self._scan.filter(self.choice.of(path, modified)).select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_block_start").alias("block_start"),
            modified.alias("modified"),
            F.is_valid_utf8("value").alias("decodable"),
            values.parse_number(F.col("value")).alias("number"),
            F.monotonically_increasing_id().alias("line"),
        )
        value = F.col("number").cast("float").cast("double") if self.single_precision else F.col("number")
        return (
            parsed.filter((values.is_finite(value) | ~F.col("decodable")) & (F.col("line") >= 0))
            .select("uri", "block_start", "modified", "decodable", value.alias("value"))
            .withColumn("id", F.monotonically_increasing_id())
        )

    @cached_property
    def _stored(self) -> DataFrame:
        """The parsed rows as a table: the tree is read and parsed once."""
        return written(self._lines(), "lines")

    @cached_property
    def _blocks(self) -> DataFrame:
        """One row per block of a file: its first id, its sample count, and whether it can be decoded. Kept as a table.

        Counts combine before the shuffle, so this pass moves one row per block and nothing per sample.
        """
        blocks = self._stored.groupBy("uri", "block_start").agg(
            F.min("id").alias("first_id"),
            F.count("*").alias("size"),
            F.bool_and("decodable").alias("decodable"),
            F.max("modified").alias("modified"),
        )
        return written(blocks.withColumn("block_key", _block_key()), "blocks")

    @cached_property
    def _block_count(self) -> tuple[int, int]:
        """Blocks, and different keys of blocks."""
        found = self._blocks.agg(F.count("*").alias("rows"), F.count_distinct("block_key").alias("keys")).first()
        return found["rows"], found["keys"]

    @property
    def _placed(self) -> DataFrame:
        """The blocks of readable files with the samples before them; the first id of a file stands for the file."""
        per_file = Window.partitionBy("uri")
        before = per_file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
        return (
            self._blocks.withColumns(
                {
                    "start": F.coalesce(F.sum("size").over(before), F.lit(0)),
                    "n": F.sum("size").over(per_file),
                    "file_id": F.min("first_id").over(per_file),
                    "readable": F.bool_and("decodable").over(per_file),
                }
            )
            .filter("readable")
            .drop("readable", "decodable")
        )

    @property
    def signals(self) -> DataFrame:
        """``file_id``, ``source_file``, ``modified`` and ``n`` of every readable file."""
        first = self._placed.filter("first_id = file_id")
        return first.select("file_id", paths.plain_path(F.col("uri")).alias("source_file"), "modified", "n")

    @property
    def samples(self) -> DataFrame:
        """``file_id``, ``pos``, ``n``, ``value`` of every readable file.

        Blocks are found by a hash of path and offset where that hash tells all of them apart, which keeps the
        broadcast table small: reckoned at 80 bytes a block, it holds the 15 MB files of some 100 TB. A larger table is
        joined by shuffle.
        """
        rows, keys = self._block_count
        key = ["block_key"] if rows == keys else ["uri", "block_start"]
        row_bytes = HASHED_BLOCK_BYTES if rows == keys else NAMED_BLOCK_BYTES
        placed = self._placed.select(*key, "first_id", "start", "n", "file_id")
        bounded = broadcast_if_small(placed, rows, row_bytes, BLOCK_TABLE_BYTES)
        lines = self._stored.withColumn("block_key", _block_key())
        pos = F.col("id") - F.col("first_id") + F.col("start")
        return lines.join(bounded, key).select("file_id", pos.alias("pos"), "n", "value")

    def named(self, df: DataFrame) -> DataFrame:
        """``df`` with ``source_file`` and ``modified`` in place of ``file_id``."""
        signals = self.signals.drop("n")
        bounded = broadcast_if_small(signals, self._block_count[0], NAMED_BLOCK_BYTES)
        return df.join(bounded, "file_id").drop("file_id")

    @property
    def skipped(self) -> DataFrame:
        """Files that give no samples, with the reason. One bad file never fails a run."""
        path = paths.plain_path(F.col("uri")).alias("source_file")
        seen = self._blocks.groupBy(path).agg(F.bool_and("decodable").alias("decodable"))
        reason = F.when(F.col("decodable").isNull(), "no finite numeric samples").when(
            ~F.col("decodable"), "not valid UTF-8"
        )
        joined = self.files.select("source_file").join(seen, "source_file", "left")
        return joined.select("source_file", reason.alias("reason")).filter("reason IS NOT NULL")

    @property
    def undated(self) -> DataFrame:
        """Files whose path names an impossible date. Their samples are used, with a NULL date."""
        path = F.col("source_file")
        return self.files.filter(paths.event_date(path, F.col("modified")).isNull()).select(
            "source_file", F.lit("impossible date").alias("reason")
        )

    @property
    def quarantine(self) -> DataFrame:
        """What someone should look at: skipped files and those with an impossible date."""
        return self.skipped.unionByName(self.undated)


def _block_key() -> Column:
    return F.xxhash64("uri", "block_start")
