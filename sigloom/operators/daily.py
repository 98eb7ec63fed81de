"""Daily figures per line, kept up to date by recomputing only the days and lines that changed. The table is ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.operators.joins import attach
from sigloom.operators.messages import latest_per_key

DAY = ["event_date", "line_number"]
#: A signal counts once a day and line, by its latest judgement.
SIGNAL = ["source_file", "channel"]


def daily_summary(summary: DataFrame) -> DataFrame:
    """``event_date, line_number, files, reviews, review_share, mean_score, max_score`` of summary rows.

    Of several judgements of a signal the last one counts, by time and then by run. Signals without a score count as
    files but not in the scores. Null dates and lines are groups like others; no rows give none.
    """
    latest = latest_per_key(summary.select(*DAY, *SIGNAL, "processed_at", "run_id", "cpd_score", "quality_decision"), [*DAY, *SIGNAL], ["processed_at", "run_id"])
    files, reviews = F.count("*"), F.count_if(F.col("quality_decision") == "REVIEW")
    return latest.groupBy(*DAY).agg(
        files.alias("files"),
        reviews.alias("reviews"),
        (reviews / files).alias("review_share"),
        F.avg("cpd_score").alias("mean_score"),
        F.max("cpd_score").alias("max_score"),
    )


def touched_days(incoming: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Days and lines that a run changes: those of its rows, and those that rows which it replaces in ``before`` leave."""
    days = incoming.select(*DAY)
    if before is not None:
        replaced = attach(before.select(*DAY, *fixed.SUMMARY_KEY), incoming.select(*fixed.SUMMARY_KEY).distinct(), fixed.SUMMARY_KEY, "left_semi")
        days = days.unionByName(replaced.select(*DAY))
    return days.distinct()


def updated_daily(known: DataFrame, summary: DataFrame, touched: DataFrame) -> DataFrame:
    """The daily table after a change of ``summary``. Only rows of touched days and lines are read for it.

    Days and lines without any rows left go.
    """
    return attach(known, touched, DAY, "left_anti").unionByName(daily_summary(attach(summary, touched, DAY, "left_semi")))
