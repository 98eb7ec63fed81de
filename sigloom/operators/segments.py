"""Segment statistics and per-signal summaries of numbered samples (keys, ``pos``, ``n``, ``value``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import segments as seg


def segment_stats(samples: DataFrame, keys: Sequence[str], segments: int = fixed.SEGMENT_COUNT) -> DataFrame:
    """``segments`` rows per signal with count, mean, population deviation, minimum and maximum.

    A signal with fewer samples than segments gets empty rows (count 0, no statistics) behind its last sample.
    """
    keys = list(keys)
    stats = (
        samples.withColumn("__seg", seg.segment_index(F.col("pos"), F.col("n"), segments))
        .groupBy(*keys, "__seg")
        .agg(
            F.max("n").alias("__n"),
            F.count("*").cast("int").alias("sample_count"),
            F.avg("value").alias("mean_value"),
            F.stddev_pop("value").alias("std_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )
    # The last sample of a short signal sits in segment n; that row also stands in for n+1 .. segments.
    last = F.when((F.col("__n") < segments) & (F.col("__seg") == F.col("__n")), F.lit(segments))
    filled = stats.withColumn("segment_index", F.explode(F.sequence("__seg", F.coalesce(last, F.col("__seg")))))
    own = F.col("segment_index") == F.col("__seg")
    measures = ["mean_value", "std_value", "min_value", "max_value"]
    return filled.select(
        *keys,
        "segment_index",
        seg.parity_group(F.col("segment_index")).alias("parity_group"),
        seg.parity_order(F.col("segment_index")).alias("parity_order"),
        F.when(own, F.col("sample_count")).otherwise(0).alias("sample_count"),
        *[F.when(own, F.col(m)).alias(m) for m in measures],
    )


def signal_summary(
    segments: DataFrame, keys: Sequence[str], threshold: float = fixed.DRIFT_THRESHOLD, carry: Sequence[Column] = ()
) -> DataFrame:
    """One row per signal: odd and even means, their gap, the drift score and the decision.

    ``carry`` takes further aggregates to keep, such as ``F.max("processed_at").alias("processed_at")``.
    """
    weighted = F.col("mean_value") * F.col("sample_count")

    def side(group: str, value: Column, nothing: float | int) -> Column:
        return F.sum(F.when(F.col("parity_group") == group, value).otherwise(nothing))

    sums = segments.groupBy(*keys).agg(
        F.count("*").alias("record_count"),
        F.sum("sample_count").alias("total_samples"),
        side("odd", weighted, 0.0).alias("odd_sum"),
        side("odd", F.col("sample_count"), 0).alias("odd_count"),
        side("even", weighted, 0.0).alias("even_sum"),
        side("even", F.col("sample_count"), 0).alias("even_count"),
        *carry,
    )
    odd = F.when(F.col("odd_count") > 0, F.col("odd_sum") / F.col("odd_count"))
    even = F.when(F.col("even_count") > 0, F.col("even_sum") / F.col("even_count"))
    means = sums.withColumns({"odd_pattern_mean": odd, "even_pattern_mean": even}).drop(
        "odd_sum", "odd_count", "even_sum", "even_count"
    )
    score = seg.drift_score(F.col("odd_pattern_mean"), F.col("even_pattern_mean"))
    return means.withColumns(
        {
            "odd_even_gap": seg.odd_even_gap(F.col("odd_pattern_mean"), F.col("even_pattern_mean")),
            "cpd_score": score,
            "quality_decision": seg.quality_decision(score, threshold),
        }
    )


def in_contract(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly the given columns, in order and type."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
