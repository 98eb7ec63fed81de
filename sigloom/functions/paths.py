"""What a file path says about a signal, as the batch job reads it.

The publish job reads names by other rules (``functions/instances.py``); the two disagree on some files on purpose.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed

LOCAL_SCHEME = "^file:/+"


def plain_path(uri: Column) -> Column:
    """The readable path behind a ``_metadata.file_path`` value; local files lose their ``file:`` scheme."""
    # '+' stands for itself in these URIs, while url_decode would turn it into a space.
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, LOCAL_SCHEME, "/")


def below(path: Column, root: str) -> Column:
    """The part of a plain path below a qualified root."""
    top = re.sub(LOCAL_SCHEME, "/", root).rstrip("/")
    return F.when(F.startswith(path, F.lit(f"{top}/")), F.substring(path, F.lit(len(top) + 2), F.length(path))).otherwise(path)


def path_parts(path: Column) -> Column:
    """Paths sort by their parts, not by their characters: ``a/b`` comes before ``a-b/c``."""
    return F.split(path, "/")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.csv$", "")


def dashed(digits: Column) -> Column:
    """``20220417`` -> ``2022-04-17``, which a cast reads faster than a pattern does."""
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))


def event_date(path: Column, modified: Column | None = None, digits: Column | None = None) -> Column:
    """The leftmost date in the path, else the day the file was modified; NULL for an impossible date."""
    digits = F.regexp_extract(path, fixed.PATH_DATE_PATTERN, 0) if digits is None else digits
    fallback = F.lit(None).cast("date") if modified is None else modified.cast("date")
    return F.when(digits == "", fallback).otherwise(dashed(digits).try_cast("date"))


def line_number(name: Column) -> Column:
    """The digits before the first underscore, else 1. A name that starts with its date yields the date."""
    return F.coalesce(F.regexp_extract(name, fixed.LINE_PREFIX_PATTERN, 1).try_cast("int"), F.lit(1))


def line_id(number: Column) -> Column:
    return F.format_string(fixed.LINE_ID_FORMAT, number)


def battery_id(digits: Column) -> Column:
    """``010`` -> ``battery_10``."""
    return F.concat(F.lit("battery_"), F.regexp_replace(digits, "^0+(?=[0-9])", ""))


def without_channel_suffix(stem: Column) -> Column:
    return F.regexp_replace(stem, fixed.TRAILING_CHANNEL_PATTERN, "")


def product_id(stem: Column) -> Column:
    digits = F.regexp_extract(stem, fixed.BATTERY_PATTERN, 1)
    plain = without_channel_suffix(F.regexp_replace(stem, fixed.LINE_PREFIX_PATTERN, ""))
    return F.when(digits != "", battery_id(digits)).otherwise(plain)


def channel(path: Column) -> Column:
    """Channel 0 when any of its tokens is in the path, else 1 when any of its own is, else 0."""
    lowered = F.lower(path)
    is_0, is_1 = (
        lowered.rlike("|".join(tokens)) for tokens in (fixed.CHANNEL_0_PATH_TOKENS, fixed.CHANNEL_1_PATH_TOKENS)
    )
    return F.when(is_0, 0).when(is_1, 1).otherwise(0)


def source_parts(path: Column) -> dict[str, Column]:
    """What several metadata columns are made of, to be settled before them."""
    return {"__name": file_name(path), "__digits": F.regexp_extract(path, fixed.PATH_DATE_PATTERN, 0)}


def source_columns(path: Column, modified: Column | None = None, parts: bool = False) -> dict[str, Column]:
    """All metadata columns of a signal file, by output name. With ``parts`` the columns of ``source_parts`` are there."""
    name = F.col("__name") if parts else file_name(path)
    number = line_number(name)
    return {
        "source_file": path,
        "file_name": name,
        "event_date": event_date(path, modified, F.col("__digits") if parts else None),
        "line_number": number,
        "line_id": line_id(number),
        "product_id": product_id(file_stem(name)),
        "channel": channel(path),
    }
