"""Text to samples, and values that are computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that may surround a number.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# Digits may hold single underscores.
DIGITS = "[0-9](?:_?[0-9])*"
NUMBER = rf"^[+-]?(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
# A cast also takes '1.0d', '1.0f' and hexadecimal floats, which are not numbers here.
LETTERS_OF_OTHER_NUMBERS = "dDfFxX"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def parse_number(line: Column) -> Column:
    """The last comma-separated field as a double, which may be infinite or NaN; NULL for headers and blanks.

    Nearly every line is settled by a cast. Only what the cast refuses, or might have taken too easily, is held
    against the full pattern, which costs several times as much.
    """
    field = F.trim(F.substring_index(line, ",", -1))
    number = field.try_cast("double")
    doubtful = F.lit(False)
    for letter in LETTERS_OF_OTHER_NUMBERS:
        doubtful = doubtful | F.contains(field, F.lit(letter))
    trimmed = F.btrim(field, F.lit(BLANKS))
    checked = F.when(trimmed.rlike(NUMBER), F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(number.isNotNull() & ~doubtful, number).otherwise(checked)


def parse_sample(line: Column) -> Column:
    """The last comma-separated field as a finite double; NULL for headers, blanks, NaN and infinities."""
    return finite(parse_number(line))


def is_finite(value: Column) -> Column:
    """Neither NULL nor NaN nor infinite, in the form a Parquet scan can check. NaN counts as larger than infinity."""
    return (value > F.lit(float("-inf"))) & (value < F.lit(float("inf")))


def finite(value: Column) -> Column:
    return F.when(is_finite(value), value)


def single_precision(value: Column) -> Column:
    """The value as 32-bit float, widened again, as published samples carry it; NULL beyond that range."""
    return finite(value.cast("float").cast("double"))
