"""Columns computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with added columns that are computed once per row.

    The optimizer copies the definition of a plain derived column into every expression and filter that uses it, which
    repeats costly parsing dozens of times. It does not copy through a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
