"""Keep only what belongs to the oldest day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_oldest_date(df: DataFrame, date: Column) -> DataFrame:
    """Rows of the earliest non-NULL date. The date itself is one value, so it is looked up first and then pushed down."""
    oldest = df.agg(F.min(date).alias("d")).first()["d"]
    return df.filter(date == F.lit(oldest))
