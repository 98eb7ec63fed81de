"""Ids, keys and bounds of chunk messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions.instances import channel_code
from sigloom.functions.segments import whole_division
from sigloom.functions.values import once


def message_id(instance_id: Column, lead_num: Column, channel: Column, chunk_index: Column) -> Column:
    """Same chunk, same id: this is what consumers drop repeats by."""
    return F.format_string(fixed.MESSAGE_ID_FORMAT, instance_id, lead_num, channel_code(channel), chunk_index)


def partition_key(line_id: Column, instance_id: Column, lead_num: Column, channel: Column) -> Column:
    """One key per signal."""
    return F.format_string(fixed.PARTITION_KEY_FORMAT, line_id, instance_id, lead_num, channel_code(channel))


def key_hash(key: Column) -> Column:
    """32-bit hash of the UTF-8 bytes of a key as an unsigned ``bigint``, the one that brokers' clients use by default.

    Products of two 32-bit numbers stay below 2^63 here, so plain ``bigint`` arithmetic does. A null key has no hash.
    """
    low, factor = F.lit(0xFFFFFFFF), F.lit(fixed.KEY_HASH_FACTOR)
    word_shift, *last_shifts = fixed.KEY_HASH_SHIFTS

    def times(number: Column) -> Column:
        return (number * factor).bitwiseAND(low)

    def folded(number: Column, shift: int) -> Column:
        return once(number, lambda x: x.bitwiseXOR(F.shiftrightunsigned(x, shift)))

    def little_endian(data: Column, first: Column, count: int) -> Column:
        backwards = [data.substr(first + k, F.lit(1)) for k in reversed(range(count))]
        return F.conv(F.hex(F.concat(*backwards)), 16, 10).cast("bigint")

    def hashed(data: Column) -> Column:
        size = F.octet_length(data)
        words, rest = whole_division(size, 4).cast("int"), size % 4
        starts = F.when(words > 0, F.transform(F.sequence(F.lit(1), words), lambda w: w * 4 - 3)).otherwise(F.array().cast("array<int>"))
        seeded = F.lit(fixed.KEY_HASH_SEED).bitwiseXOR(size.cast("bigint"))
        h = F.aggregate(starts, seeded, lambda h, at: times(h).bitwiseXOR(times(folded(times(little_endian(data, at, 4)), word_shift))))
        tail = F.when(rest == 0, F.lit(None).cast("bigint"))
        for count in (1, 2, 3):
            tail = tail.when(rest == count, little_endian(data, words * 4 + 1, count))
        h = once(h, lambda x: F.coalesce(times(x.bitwiseXOR(tail)), x))
        for shift in last_shifts[:1]:
            h = times(folded(h, shift))
        return folded(h, last_shifts[-1])

    return F.when(key.isNotNull(), once(F.encode(key, "UTF-8"), hashed))


def broker_partition(key: Column, partitions: int) -> Column:
    """The partition, of so many, in which a broker's own client puts a key. A null key may go to any, so it has none."""
    if partitions < 1:
        raise ValueError("a topic has at least one partition")
    return (key_hash(key).bitwiseAND(F.lit(0x7FFFFFFF)) % partitions).cast("int")


def chunk_index(pos: Column, size: int) -> Column:
    if size < 1:
        raise ValueError("chunk size must be >= 1")
    return whole_division(pos, size)


def total_chunks(total: Column, size: int) -> Column:
    if size < 1:
        raise ValueError("chunk size must be >= 1")
    return F.greatest(F.lit(1).cast("bigint"), whole_division(total + (size - 1), size))


def chunk_bounds(index: Column, total: Column, size: int) -> tuple[Column, Column]:
    """First sample, and the one after the last."""
    start = index * F.lit(size).cast("bigint")
    return start, F.least(start + size, total)
