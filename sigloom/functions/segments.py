"""Expressions for near-equal slices of an ordered signal and for their odd/even comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed


def whole_division(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a.cast("bigint"), F.lit(b).cast("bigint"))


def segment_index(pos: Column, total: Column, segments: int) -> Column:
    """1-based slice of position ``pos`` among ``total``; the first ``total % segments`` slices are one longer.

    Same as ``ntile(segments)`` over the order of ``pos``, but needs no second sort.
    """
    if segments < 1:
        raise ValueError("segments must be >= 1")
    size = whole_division(total, segments)
    longer = total % segments
    in_longer = longer * (size + 1)
    return (
        F.when(pos < in_longer, whole_division(pos, size + 1))
        .otherwise(longer + whole_division(pos - in_longer, F.greatest(size, F.lit(1))))
        .cast("int")
        + 1
    )


def parity_group(segment: Column) -> Column:
    return F.when(segment % 2 == 1, "odd").otherwise("even")


def parity_order(segment: Column) -> Column:
    return whole_division(segment + 1, 2).cast("int")


def odd_even_gap(odd_mean: Column, even_mean: Column) -> Column:
    return F.abs(odd_mean - even_mean)


def drift_score(odd_mean: Column, even_mean: Column) -> Column:
    """Odd/even gap relative to both means, within [0, 1]; NULL when a side has no samples."""
    scale = F.greatest(F.abs(odd_mean) + F.abs(even_mean), F.lit(fixed.SCORE_FLOOR))
    return odd_even_gap(odd_mean, even_mean) / scale


def quality_decision(score: Column, threshold: float = fixed.DRIFT_THRESHOLD) -> Column:
    """REVIEW from the threshold on; a missing score passes."""
    return F.when(score >= F.lit(threshold), "REVIEW").otherwise("PASS")


def quality_gate(score: Column, warn: float, hold: float) -> Column:
    """Three levels. No thresholds are given for these, so both must be passed."""
    if warn > hold:
        raise ValueError("warn must not exceed hold")
    return F.when(score >= F.lit(hold), "HOLD").when(score >= F.lit(warn), "WARNING").otherwise("PASS")


def hour_window(moment: Column) -> tuple[Column, Column]:
    start = F.date_trunc("hour", moment)
    return start, start + F.expr("INTERVAL 1 HOUR")
