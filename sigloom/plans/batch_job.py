"""Signal files -> segments, summary and a run row."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.operators.batch import segment_rows, summary_rows
from sigloom.shared_storage import path_exists, scratch, written
from sigloom.sinks.external import DATABASE_TABLES, POSTGRES_TYPES, ensure_tables, upsert_database
from sigloom.sinks.tables import append_partitioned, run_row, upsert_table
from sigloom.sources.files import SignalFiles, choose_files

logger = logging.getLogger(__name__)

OK, NO_FILES, NO_SIGNALS = 0, 2, 3


@dataclass(frozen=True)
class BatchResult:
    code: int
    run_id: str
    total_files: int = 0
    skipped_files: int = 0
    segment_rows: int = 0
    summary_rows: int = 0
    seconds: float = 0.0

    def per_second(self, amount: int) -> float:
        return amount / self.seconds if self.seconds > 0 else 0.0


def run_batch(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    run_id: str | None = None,
    segments: int = fixed.SEGMENT_COUNT,
    threshold: float = fixed.DRIFT_THRESHOLD,
    max_files: int = 0,
    oldest_date_only: bool = False,
    mode: str = "append",
) -> BatchResult:
    """Run over a tree of CSV signals with the caller's session; the session decides where it runs.

    ``mode`` is ``append`` (date and line partitions, a rerun adds rows) or ``upsert`` (run partitions, a rerun
    replaces rows). Either way a row in ``runs`` tells how the run ended.
    """
    if mode not in ("append", "upsert"):
        raise ValueError("mode must be 'append' or 'upsert'")
    run_id = str(uuid.UUID(run_id)) if run_id else str(uuid.uuid4())
    started_at = datetime.now(timezone.utc)
    total_files = 0
    if path_exists(spark, input_dir):
        source = SignalFiles(spark, input_dir, choose_files(spark, input_dir, max_files, oldest_date_only))
        total_files = source.files.count()
    if total_files == 0:
        logger.warning("no CSV files in %s", input_dir)
        return BatchResult(NO_FILES, run_id)

    def log_run(status: str, segment_count: int = 0, summary_count: int = 0) -> datetime:
        finished_at = datetime.now(timezone.utc)
        row = run_row(
            spark, run_id, status, started_at, finished_at, total_files, segment_count, summary_count, output_dir
        )
        upsert_table(row, f"{output_dir}/runs", fixed.RUN_KEY)
        return finished_at

    with scratch(spark):
        try:
            # Both outputs come from these rows; kept as a table, they outlive a lost executor.
            made = Observation("segments")
            rows = segment_rows(source, run_id, started_at, segments).observe(made, F.count(F.lit(1)).alias("rows"))
            segments_df = written(rows, "segments")
            summary_df = summary_rows(segments_df, threshold)
            segment_count = made.get.get("rows", 0)  # counted by the write itself
            if segment_count == 0:
                logger.error("no valid signals in %s", input_dir)
                log_run("FAILED")
                return BatchResult(NO_SIGNALS, run_id, total_files, total_files)
            if mode == "append":
                append_partitioned(segments_df, f"{output_dir}/segments")
                append_partitioned(summary_df, f"{output_dir}/summary")
            else:
                upsert_table(segments_df, f"{output_dir}/segments", fixed.SEGMENT_KEY)
                upsert_table(summary_df, f"{output_dir}/summary", fixed.SUMMARY_KEY)
            # Every signal has exactly ``segments`` segment rows and one summary row.
            summary_count = segment_count // segments
            skipped = source.skipped.count()
            finished_at = log_run("SUCCESS", segment_count, summary_count)
        except Exception:
            log_run("FAILED")
            raise
    seconds = (finished_at - started_at).total_seconds()
    result = BatchResult(OK, run_id, total_files, skipped, segment_count, summary_count, seconds)
    logger.info(
        "run %s: %s files, %s skipped, %s segment rows, %s summary rows, %.2f s, %.2f files/s",
        run_id, total_files, skipped, segment_count, summary_count, seconds, result.per_second(total_files),
    )
    return result


def export_run(
    spark: SparkSession, output_dir: str, run_id: str, url: str, table_prefix: str = "", types: dict[str, str] = POSTGRES_TYPES, **login
) -> None:
    """Upsert one run's segments, summary and run row into a database, making its tables where they are missing.

    Of repeated runs, the last one counts.
    """
    ensure_tables(spark, url, table_prefix, types, login.get("user", ""), login.get("password", ""))
    for name in DATABASE_TABLES:
        rows = spark.read.parquet(f"{output_dir}/{name}").filter(F.col("run_id") == run_id)
        if "processed_at" in rows.columns:
            last = rows.agg(F.max("processed_at").alias("t")).select(F.col("t").cast("string")).first()["t"]
            rows = rows.filter(F.col("processed_at") == F.lit(last).cast("timestamp"))
        upsert_database(rows, url, name, f"{table_prefix}{name}", **login)
