"""Spans that operators find in a text, and the digests that queries make of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Places in code points, end exclusive; ``base`` marks what the plain patterns find by themselves.
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def of_kind(spans: Column, kind: str) -> Column:
    """How many base spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_digest(spans: Column) -> Column:
    return F.sha2(listed(F.filter(spans, lambda s: s["base"])), 256)
