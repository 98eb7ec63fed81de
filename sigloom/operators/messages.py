"""Chunk messages: build, write as JSON, parse, check, sort out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import instances as inst
from sigloom.functions import messages as msg
from sigloom.operators.columns import settled

MESSAGE_COLUMNS = list(fixed.MESSAGE_FIELDS)
# Text fields are parsed as VARIANT, which keeps the type that the JSON value had.
JSON_SCHEMA = ", ".join(f"{name} {kind.replace('STRING', 'VARIANT')}" for name, kind in fixed.MESSAGE_FIELDS.items())
METADATA_SCHEMA = fixed.MESSAGE_FIELDS["metadata"]
SIGNAL_KEY = ["product_instance_id", "lead_num", "channel"]
# Takes any text that does not fit the types.
CORRUPT = "_corrupt"
# Names of text fields that hold something else.
MISTYPED = "_mistyped"


def build_messages(chunks: DataFrame) -> DataFrame:
    """Message columns of chunk rows that already carry their item: ids, line, times, lead, channel, file name."""
    lead, channel, index = F.col("lead_num"), F.col("channel"), F.col("chunk_index")
    instance = F.col("product_instance_id")
    metadata = F.struct(
        F.lit(fixed.MESSAGE_SOURCE).alias("source"),
        F.lit(fixed.MESSAGE_VERSION).alias("version"),
        F.concat_ws("_", F.col("line_number").cast("string"), "file_name").alias("file_name"),
        "original_product_instance_id",
        "is_duplicate",
        "replay_iteration",
    )
    whole = ["lead_num", "channel", "chunk_index", "total_chunks", "start_sample", "end_sample"]
    return chunks.withColumns(
        {name: F.col(name).cast("int") for name in whole}
        | {
            "message_id": msg.message_id(instance, lead, channel, index),
            "lead_type": inst.lead_type(lead),
            "channel_name": inst.channel_name(channel),
            "sample_rate_hz": F.lit(fixed.SAMPLE_RATE_HZ),
            "event_time": inst.iso_utc(F.col("event_time")),
            "metadata": metadata,
        }
    ).select(*MESSAGE_COLUMNS)


def keyed_json(messages: DataFrame, topic: str) -> DataFrame:
    """``topic``, ``key``, ``value`` rows as a Kafka sink takes them."""
    key = msg.partition_key(F.col("line_id"), F.col("product_instance_id"), F.col("lead_num"), F.col("channel"))
    value = F.to_json(F.struct(*MESSAGE_COLUMNS), {"ignoreNullFields": "false"})
    return messages.select(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"), "chunk_index")


def in_key_order(rows: DataFrame) -> DataFrame:
    """Each key's chunks in order, one after the other. Ranges split a key with very many chunks over tasks: for files."""
    return rows.repartitionByRange("key", "chunk_index").sortWithinPartitions("key", "chunk_index")


def by_key_in_order(rows: DataFrame) -> DataFrame:
    """The same with each key whole in one partition, so that one task sends it in order. A key is one signal."""
    return rows.repartition("key").sortWithinPartitions("key", "chunk_index")


def parse_messages(raw: DataFrame, column: str = "value") -> DataFrame:
    """Message columns next to the raw text, which is needed for dead letters.

    A text field whose JSON value is no text has that value's text, and its name is in the column ``_mistyped``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = settled(raw, __m=F.from_json(column, f"{JSON_SCHEMA}, {CORRUPT} STRING", options))
    plain = [name for name, kind in fixed.MESSAGE_FIELDS.items() if kind == "STRING"]
    nested = [f"metadata.{f.split(':')[0].strip()}" for f in METADATA_SCHEMA.removeprefix("STRUCT<").split(",") if "STRING" in f]
    kind = lambda name: F.schema_of_variant(F.col(f"__m.{name}"))
    wrong = [F.when(~kind(name).isin("STRING", "VOID"), F.lit(name)) for name in [*plain, *nested]]
    text = {name: F.col(f"__m.{name}").cast("string") for name in plain}
    metadata = F.col("__m.metadata").cast(METADATA_SCHEMA)
    columns = [text.get(name, metadata if name == "metadata" else F.col(f"__m.{name}")).alias(name) for name in MESSAGE_COLUMNS]
    return rows.select(*raw.columns, *columns, f"__m.{CORRUPT}", F.array_compact(F.array(*wrong)).alias(MISTYPED))


def contract_errors() -> Column:
    """Names of the rules a parsed message breaks; a text that does not parse breaks just one."""
    is_date_time = F.col("event_time").rlike(fixed.DATE_TIME_PATTERN) & F.try_to_timestamp("event_time").isNotNull()
    broken: list[tuple[str, Column]] = [
        *[(f"missing:{name}", F.col(name).isNull()) for name in fixed.REQUIRED_MESSAGE_FIELDS],
        *[
            (f"missing:metadata.{name}", F.col("metadata").isNotNull() & F.col(f"metadata.{name}").isNull())
            for name in fixed.REQUIRED_METADATA_FIELDS
        ],
        ("range:lead_num", ~F.col("lead_num").between(1, fixed.LEADS_WHEN_COMPLETE)),
        ("enum:lead_type", ~F.col("lead_type").isin(*fixed.LEAD_TYPES)),
        ("enum:channel", ~F.col("channel").isin(0, 1)),
        ("enum:channel_name", ~F.col("channel_name").isin(*fixed.CHANNEL_NAMES)),
        ("range:chunk_index", F.col("chunk_index") < 0),
        ("range:total_chunks", F.col("total_chunks") < 1),
        ("range:chunk_index >= total_chunks", F.col("total_chunks").between(1, F.col("chunk_index"))),
        ("const:sample_rate_hz", F.col("sample_rate_hz") != fixed.SAMPLE_RATE_HZ),
        ("type:samples", F.exists("samples", lambda v: v.isNull())),
        ("format:event_time", F.col("event_time").isNotNull() & ~is_date_time),
    ]
    rules = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in broken]))
    unreadable = F.col(CORRUPT).isNotNull()
    types = F.transform(MISTYPED, lambda name: F.concat(F.lit("type:"), name))
    # Most messages break none, and for these no list is made.
    any_broken = F.coalesce(reduce(Column.__or__, [condition for _, condition in broken]), F.lit(False)) | (F.size(MISTYPED) > 0)
    return F.when(unreadable, F.array(F.lit("unreadable"))).when(any_broken, F.concat(types, rules)).otherwise(F.array().cast("array<string>"))


def check_messages(raw: DataFrame, column: str = "value") -> DataFrame:
    """Parsed messages with their ``errors``; none means valid."""
    return parse_messages(raw, column).withColumn("errors", contract_errors())


def valid_messages(checked: DataFrame) -> DataFrame:
    """Messages that keep the contract, with a real timestamp."""
    valid = checked.filter(F.size("errors") == 0)
    return valid.select(*[c for c in MESSAGE_COLUMNS if c != "event_time"], F.to_timestamp("event_time").alias("event_time"))


def without_read_texts(checked: DataFrame, column: str = "value") -> DataFrame:
    """What ``valid_messages`` and ``dead_letters`` need: the raw text only of messages that break a rule."""
    text = F.when(F.size("errors") > 0, F.col(column)).alias(column)
    return checked.select(text, *MESSAGE_COLUMNS, "errors")


def dead_letters(checked: DataFrame, column: str = "value") -> DataFrame:
    """Raw text and reasons of the others."""
    return checked.filter(F.size("errors") > 0).select(F.col(column).alias("value"), "errors")


def drop_repeats(messages: DataFrame, key: Sequence[str] = ("message_id",)) -> DataFrame:
    """At-least-once delivery made once. Repeats are dropped before the shuffle too, so many copies of one do no harm.

    Rows are sorted by the key on both sides of the shuffle, since Spark hashes no rows with text or arrays in them.
    """
    return messages.dropDuplicates(list(key))


def without_replays(messages: DataFrame) -> DataFrame:
    """Only first-hand messages; replays are for load tests."""
    return messages.filter(~F.col("metadata.is_duplicate"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, as a compacted topic keeps it. Combined before the shuffle; rows are sorted by key, not within."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*")


def channel_presence(complete: DataFrame) -> DataFrame:
    """Per (instance, lead) of complete signals: whether both channels arrived."""
    arrived = [F.bool_or(F.col("channel") == c).alias(f"has_channel_{c}") for c in (0, 1)]
    return (
        complete.groupBy("product_instance_id", "lead_num")
        .agg(*arrived)
        .withColumn("has_both", F.col("has_channel_0") & F.col("has_channel_1"))
    )
