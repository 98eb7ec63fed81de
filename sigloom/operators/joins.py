"""Join conditions and size checks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table may be broadcast only when it is known to stay below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys in which two NULLs are equal."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the non-key columns of ``right``; keys may be NULL."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def broadcast_if_small(
    df: DataFrame, row_bound: int, row_bytes: int = 256, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark for broadcast when at most ``row_bound`` rows can exist and they fit; otherwise leave the choice to Spark."""
    return F.broadcast(df) if row_bound * row_bytes <= limit else df
