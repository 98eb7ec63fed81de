"""What a file path says about a product instance, as the publish job reads it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import paths

def event_time(date: Column, time: Column | None = None) -> Column:
    """Time of eight and six digits, midnight if the latter are not given; NULL for an impossible one."""
    day = paths.dashed(date)
    if time is None:
        return day.try_cast("timestamp")
    clock = F.concat_ws(":", F.substring(time, 1, 2), F.substring(time, 3, 2), F.substring(time, 5, 2))
    return F.concat_ws(" ", day, clock).try_cast("timestamp")


def iso_utc(moment: Column) -> Column:
    """ISO text with a Z; the fraction shows only when there is one. The session time zone must be UTC."""
    seconds = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, "SSSSSS")
    return F.concat(seconds, F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("Z"))


def lead_type(lead_num: Column) -> Column:
    return F.when(lead_num % 2 == 1, fixed.LEAD_TYPES[0]).otherwise(fixed.LEAD_TYPES[1])


def channel_code(channel: Column) -> Column:
    return F.when(channel == 0, fixed.CHANNEL_CODES[0]).otherwise(fixed.CHANNEL_CODES[1])


def channel_name(channel: Column) -> Column:
    return F.when(channel == 0, fixed.CHANNEL_NAMES[0]).otherwise(fixed.CHANNEL_NAMES[1])


def line_number(line_id: Column) -> Column:
    """Trailing digits of a line id, else 1."""
    return F.coalesce(F.regexp_extract(line_id, fixed.TRAILING_DIGITS_PATTERN, 1).try_cast("int"), F.lit(1))


def lookup(table: dict[str, int], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def folder_channel(relative_path: Column) -> Column:
    parts = F.transform(paths.path_parts(relative_path), F.lower)
    return lookup(fixed.FOLDER_CHANNELS, F.get(F.filter(parts, lambda p: p.isin(*fixed.FOLDER_CHANNELS)), F.lit(0)))


def folder_date(relative_path: Column) -> Column:
    parts = paths.path_parts(relative_path)
    return F.get(F.filter(parts, lambda p: p.rlike(fixed.FOLDER_DATE_PATTERN)), F.lit(0))


def name_groups(name: Column, pattern: str, groups: int) -> Column:
    """The groups of a file-name pattern as an array, from one match; NULL if the name does not fit.

    File names hold no slash, so it can part the groups. A group that took no part is an empty text.
    """
    parted = F.regexp_replace(name, pattern, "/".join(f"${n}" for n in range(1, groups + 1)))
    return F.when(F.contains(parted, F.lit("/")), F.split(parted, "/"))
