"""Segment and summary rows of signal files, in the output contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import paths
from sigloom.functions import segments as seg
from sigloom.operators.columns import settled
from sigloom.operators.segments import in_contract, segment_stats, signal_summary
from sigloom.sources.files import SignalFiles

FILE_KEYS = ["run_id", "line_id", "line_number", "event_date", "product_id", "source_file", "channel"]


def segment_rows(
    source: SignalFiles, run_id: str, processed_at: datetime, segments: int = fixed.SEGMENT_COUNT
) -> DataFrame:
    """17 columns per segment. Metadata is worked out per segment row, after the samples are aggregated."""
    stats = source.named(segment_stats(source.samples, ["file_id"], segments))
    stats = settled(stats, **paths.source_parts(F.col("source_file")))
    meta = paths.source_columns(F.col("source_file"), F.col("modified"), parts=True)
    rows = stats.withColumns(meta | {"run_id": F.lit(run_id), "processed_at": F.lit(processed_at).cast("timestamp")})
    return in_contract(rows, fixed.SEGMENT_COLUMNS)


def summary_rows(segments: DataFrame, threshold: float = fixed.DRIFT_THRESHOLD) -> DataFrame:
    """17 columns per signal file; the window is the hour in which it was processed."""
    summary = signal_summary(segments, FILE_KEYS, threshold, [F.max("processed_at").alias("processed_at")])
    start, end = seg.hour_window(F.col("processed_at"))
    return in_contract(summary.withColumns({"window_start": start, "window_end": end}), fixed.SUMMARY_COLUMNS)
