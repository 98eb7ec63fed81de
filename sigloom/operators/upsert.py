"""Insert or replace by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sigloom.operators.joins import attach


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All incoming rows, and the existing ones whose key is not among them. Keys must be unique within ``incoming``."""
    return attach(existing, incoming.select(*keys), keys, "left_anti").unionByName(incoming)
