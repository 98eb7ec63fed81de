"""Signals that already are tables: ordered rows, or array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import values
from sigloom.operators.numbering import MAX_ROWS_PER_TASK, number_rows


def samples_from_rows(
    df: DataFrame,
    keys: dict[str, Column],
    order: Sequence[Column],
    value: Column,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Numbered samples (keys, ``pos``, ``n``, ``value``) of the finite values, ordered within their keys.

    ``order`` should tell any two samples of a signal apart; end it with the value if nothing else does.
    """
    ordering = [f"__order_{i}" for i in range(len(order))]
    slim = df.select(
        *[column.alias(name) for name, column in keys.items()],
        *[column.alias(name) for name, column in zip(ordering, order)],
        value.cast("double").alias("value"),
    ).filter(values.is_finite(F.col("value")))
    return number_rows(slim, list(keys), ordering, max_rows).drop(*ordering)


def samples_from_arrays(df: DataFrame, keys: dict[str, Column], array: Column) -> DataFrame:
    """The same from array columns. The array gives the order; a row is one signal, so nothing is shuffled."""
    clean = F.filter(array.cast("array<double>"), values.is_finite)
    return df.select(
        *[column.alias(name) for name, column in keys.items()], clean.alias("__values")
    ).select(
        *keys, F.size("__values").cast("bigint").alias("n"), F.posexplode("__values").alias("pos", "value")
    ).withColumn("pos", F.col("pos").cast("bigint"))
