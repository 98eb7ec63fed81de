"""Every operator over whole tables: the queries that are checked against SQL.

Tables stand in for signal files: events and line items are ordered samples, embeddings are array signals, orders are
product instances. Each query takes (session, folder of Parquet tables).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.functions import instances as inst
from sigloom.functions import messages as msg
from sigloom.functions import paths, values
from sigloom.functions import segments as seg
from sigloom.operators import change_points as cp
from sigloom.operators import chunks as ch
from sigloom.operators import daily
from sigloom.operators import drift
from sigloom.operators import instances as ops
from sigloom.operators import messages as mops
from sigloom.operators import replay
from sigloom.operators.columns import settled
from sigloom.operators.batch import segment_rows, summary_rows
from sigloom.operators.dates import on_oldest_date
from sigloom.operators.segments import segment_stats, signal_summary
from sigloom.operators.upsert import upsert_by_key
from sigloom.plans.batch_job import run_batch
from sigloom.plans.publish_job import InstanceScan, plan_items, plan_messages
from sigloom.shared_storage import fresh_path, write_bytes, written
from sigloom.sinks.external import write_line_files, write_message_files
from sigloom.sinks.tables import append_partitioned, upsert_table
from sigloom.sources.files import SignalFiles
from sigloom.sources.messages import stream_message_files
from sigloom.sources.tables import samples_from_arrays, samples_from_rows
from sigloom.streaming import message_streams

CHUNK = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def pick(number: Column, choices: list[Column]) -> Column:
    """Choice ``number % len(choices)``; only that one is evaluated."""
    picked = F.when(number % len(choices) == 0, choices[0])
    for i, choice in enumerate(choices[1:], start=1):
        picked = picked.when(number % len(choices) == i, choice)
    return picked


def whole(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- samples of the tables


def event_samples(spark, folder, *keys: str) -> DataFrame:
    columns = {"user_id": F.col("user_id"), "event_type": F.col("event_type"), "day": F.to_date("ts")}
    events = table(spark, folder, "events")
    return samples_from_rows(events, {k: columns[k] for k in keys}, [F.col("event_id")], F.col("value"))


def lineitem_samples(spark, folder) -> DataFrame:
    keys = {"l_suppkey": F.col("l_suppkey"), "l_linenumber": F.col("l_linenumber").cast("bigint")}
    order = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity")]
    return samples_from_rows(table(spark, folder, "lineitem"), keys, order, F.col("l_quantity"))


# --- segments and summaries

# Means of values with two decimals can end on a 5 in the seventh digit; at eight digits no rounding is a coin toss.
def measures() -> list[Column]:
    return [rounded("mean_value", 8), *[rounded(m) for m in ("std_value", "min_value", "max_value")]]


def scores() -> list[Column]:
    return [*[rounded(m, 8) for m in ("odd_pattern_mean", "even_pattern_mean", "odd_even_gap")], rounded("cpd_score")]


def _segments(samples: DataFrame, keys: list[str]) -> DataFrame:
    return segment_stats(samples, keys).select(
        *keys, *whole("segment_index"), "parity_group", *whole("parity_order", "sample_count"), *measures()
    )


def _summary(samples: DataFrame, keys: list[str]) -> DataFrame:
    return signal_summary(segment_stats(samples, keys), keys).select(
        *keys, *whole("record_count", "total_samples"), *scores(), "quality_decision"
    )


def segment_stats_by_user(spark, folder):
    return _segments(event_samples(spark, folder, "user_id"), ["user_id"])


def segment_stats_short(spark, folder):
    return _segments(event_samples(spark, folder, "user_id", "day"), ["user_id", "day"])


def segment_stats_lineitem(spark, folder):
    return _segments(lineitem_samples(spark, folder), ["l_suppkey", "l_linenumber"])


def segment_stats_embeddings(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return _segments(samples_from_arrays(vectors, {"vec_id": F.col("vec_id")}, F.col("embedding")), ["vec_id"])


def summary_by_user_and_type(spark, folder):
    keys = ["user_id", "event_type"]
    return _summary(event_samples(spark, folder, *keys), keys)


def summary_short(spark, folder):
    keys = ["user_id", "day"]
    return _summary(event_samples(spark, folder, *keys), keys)


def summary_lineitem(spark, folder):
    return _summary(lineitem_samples(spark, folder), ["l_suppkey", "l_linenumber"])


def quality_gate(spark, folder):
    keys = ["user_id", "day"]
    summary = signal_summary(segment_stats(event_samples(spark, folder, *keys), keys), keys)
    return summary.select(*keys, seg.quality_gate(F.col("cpd_score"), 0.2, 0.6).alias("gate"))


def parity_pivot(spark, folder):
    rows = segment_stats(event_samples(spark, folder, "user_id"), ["user_id"])
    return rows.groupBy("user_id").agg(
        *[
            F.sum(F.when(F.col("parity_group") == g, F.col("sample_count")).otherwise(0)).alias(f"{g}_samples")
            for g in ("odd", "even")
        ],
        *[F.count_if(F.col("parity_group") == g).alias(f"{g}_segments") for g in ("odd", "even")],
    )


def hour_window(spark, folder):
    start, end = seg.hour_window(F.col("ts").cast("timestamp"))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return (
        table(spark, folder, "events")
        .groupBy(F.date_format(start, pattern).alias("window_start"), F.date_format(end, pattern).alias("window_end"))
        .agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total_value"))
    )


def oldest_date(spark, folder):
    orders = table(spark, folder, "orders")
    kept = on_oldest_date(orders, F.to_date("o_orderdate"))
    return kept.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")


# --- paths, names and text


def top_paths(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return pages.orderBy(paths.path_parts(F.col("url")), "page_id").limit(50)


def _batch_paths(spark, folder) -> DataFrame:
    """Signal paths in all the layouts the batch job reads, named after orders."""
    key, date = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    shapes = [
        F.format_string("/data/%s/out/%d_%s_battery_%03d_laser_a.csv", date, key % 150, date, key),
        F.format_string("/data/%s/reflect/%s_battery_%d_laser_b.csv", date, date, key),
        F.format_string("/data_lake/%s/seam-%d_CH1.csv", date, key),
        F.format_string("/data/x20998877/concat_reflected_1/%d_Seam%d_LA.csv", key % 7, key),
        F.format_string("/data/plain/Battery_%05d.csv", key),
    ]
    return settled(table(spark, folder, "orders"), path=pick(key, shapes)).select("o_orderkey", "path")


def batch_file_metadata(spark, folder):
    meta = paths.source_columns(F.col("path"), parts=True)
    return settled(_batch_paths(spark, folder), **paths.source_parts(F.col("path"))).select(
        "o_orderkey",
        meta["file_name"].alias("file_name"),
        meta["event_date"].alias("event_date"),
        meta["line_number"].cast("bigint").alias("line_number"),
        meta["line_id"].alias("line_id"),
        meta["product_id"].alias("product_id"),
        meta["channel"].cast("bigint").alias("channel"),
    )


def _instance_paths(spark, folder) -> DataFrame:
    """Signal paths in all the layouts the publish job reads, and one it ignores."""
    key, date = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    lead, laser = key % 16 + 1, F.when(key % 2 == 0, "LB").otherwise("LA")
    shapes = [
        F.format_string("%s_%06d_%d_WLINE_%02d_04_PROD_%03d_%02d_%s.csv", date, key % 235960, key % 9, key % 4, key, lead, laser),
        F.format_string("out/%s_%06d_%d_W%d_07_P-%d_%02d_CH0.csv", date, key % 1000, key % 9, key % 4, key, lead),
        F.format_string("laser_b/%s/%s_battery_%03d_laser_b.csv", date, date, key),
        F.format_string("%s_battery_%d_CH1.csv", date, key),
        F.format_string("%s/Reflect/battery_%d.csv", date, key),
        F.format_string("3_%s_battery_%d_laser_a.csv", date, key),
    ]
    return settled(table(spark, folder, "orders"), path=pick(key, shapes)).select("o_orderkey", "path")


def instance_file_metadata(spark, folder):
    return ops.parse_instances(_instance_paths(spark, folder), F.col("path")).select(
        "o_orderkey", "instance_id", "product_id", "line_id", "batch_id", "sequence_id",
        *whole("lead_num", "channel"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    )


def parse_event_lines(spark, folder):
    key, value = F.col("event_id"), F.col("value").cast("decimal(12,2)").cast("string")
    shapes = [
        value,
        F.concat(key.cast("string"), F.lit(","), value),
        F.concat(value, F.lit(",")),
        F.concat(F.lit(" \t"), value, F.lit(" ")),
        F.concat(value, F.lit("d")),
        F.concat(F.lit("1_0"), value),
        F.concat(F.lit("-"), value, F.lit("e-1")),
        F.lit("value"),
        F.lit("nan"),
        F.lit("inf"),
        F.lit("1e400"),
        F.lit(""),
        F.concat(F.lit("_"), value),
        F.concat(value, F.lit(" # note")),
    ]
    lines = settled(table(spark, folder, "events"), line=pick(key, shapes))
    parsed = values.parse_sample(F.col("line"))
    return lines.select(
        "event_id", F.round(parsed, 6).alias("sample"), F.round(values.single_precision(parsed), 6).alias("single")
    )


def parse_document_lines(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.count(values.parse_sample(F.col("line"))).alias("samples")
    )


# --- instances and pairs


def _event_files(spark, folder) -> DataFrame:
    """Events as parsed signal files: user = instance, lead and channel from the event id."""
    event, user = F.col("event_id"), F.col("user_id")
    path = F.format_string("%s/%d/%d.csv", F.col("event_type"), user, event)
    return table(spark, folder, "events").select(
        F.concat(F.lit("user_"), user.cast("string")).alias("instance_id"),
        F.concat(F.lit("product_"), (event % 5).cast("string")).alias("product_id"),
        paths.line_id(user % 3 + 1).alias("line_id"),
        F.date_format("ts", "yyyyMMdd").alias("batch_id"),
        event.cast("string").alias("sequence_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        (event % 16 + 1).cast("int").alias("lead_num"),
        (seg.whole_division(event, 16) % 2).cast("int").alias("channel"),
        path.alias("path"),
    )


def product_instances(spark, folder):
    found = ops.product_instances(_event_files(spark, folder))
    return found.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


def channel_pairing(spark, folder):
    pairs = ops.lead_pairs(_event_files(spark, folder))
    return pairs.select("instance_id", *whole("lead_num"), "channel_0_path", "channel_1_path", *whole("duplicates"))


def signal_files(spark, folder):
    files = ops.signal_files(ops.lead_pairs(_event_files(spark, folder)))
    return files.select("instance_id", *whole("lead_num", "channel"), "path")


def missing_channels(spark, folder):
    missing = ops.missing_channels(ops.lead_pairs(_event_files(spark, folder)))
    return missing.select("instance_id", *whole("lead_num", "missing_channel"))


def instance_completeness(spark, folder):
    done = ops.completeness(ops.lead_pairs(_event_files(spark, folder)))
    return done.select("instance_id", *whole("leads_present", "channel_pairs", "duplicates"), "is_complete")


def only_complete(spark, folder):
    files = _event_files(spark, folder)
    kept = ops.only_complete(ops.product_instances(files), ops.lead_pairs(files))
    return kept.select("instance_id", "product_id", "line_id")


# --- replay


def _order_instances(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("instance_id"),
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("product_id"),
        paths.line_id(F.col("o_orderkey") % 3 + 1).alias("line_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("batch_id"),
        F.col("o_orderkey").cast("string").alias("sequence_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
    )


def _items(items: DataFrame) -> DataFrame:
    return items.select(
        "product_instance_id", "original_product_instance_id", "product_id", "line_id",
        *whole("line_number"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        "is_duplicate",
        *whole("replay_iteration"),
    )


def replay_expand(spark, folder):
    return _items(replay.replay_items(_order_instances(spark, folder), lines=3))


def replay_to_target(spark, folder):
    return _items(replay.replay_items(_order_instances(spark, folder), lines=2, target=50_000, interval_seconds=2.5))


def replay_one_line(spark, folder):
    return _items(replay.replay_items(_order_instances(spark, folder), max_products=100))


def replay_seeded(spark, folder):
    return _items(replay.replay_items(_order_instances(spark, folder), lines=3, seeds=[7, 11]))


def seeded_order(spark, folder):
    ordered = replay.seeded_order(_order_instances(spark, folder), [7, 11], 3)
    return ordered.select("instance_id", "line_index", "slot")


def dry_run_summary(spark, folder):
    return replay.dry_run_summary(replay.replay_items(_order_instances(spark, folder), lines=3))


# --- chunks and messages


def _event_chunks(spark, folder) -> DataFrame:
    return ch.chunk_samples(event_samples(spark, folder, "user_id"), ["user_id"], CHUNK)


def _chunk_report(chunks: DataFrame, *keys: str) -> DataFrame:
    return chunks.select(
        *keys,
        *whole("chunk_index", "total_chunks", "start_sample", "end_sample"),
        "is_last_chunk",
        F.size("samples").cast("bigint").alias("samples"),
        F.round(F.get("samples", F.lit(0)), 5).alias("first_sample"),
        F.round(F.element_at("samples", -1), 5).alias("last_sample"),
    )


def chunk_events(spark, folder):
    return _chunk_report(_event_chunks(spark, folder), "user_id")


def chunk_lineitem(spark, folder):
    keys = ["l_suppkey", "l_linenumber"]
    return _chunk_report(ch.chunk_samples(lineitem_samples(spark, folder), keys, 25), *keys)


def chunk_embeddings(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return _chunk_report(ch.chunk_arrays(vectors, "embedding", 25), "vec_id")


def partition_keys(spark, folder):
    event, user = F.col("event_id"), F.col("user_id")
    lead, channel = (event % 16 + 1).cast("int"), (seg.whole_division(event, 16) % 2).cast("int")
    line, instance = paths.line_id(user % 120), F.concat(F.lit("user_"), user.cast("string"))
    return table(spark, folder, "events").select(
        "event_id",
        msg.partition_key(line, instance, lead, channel).alias("partition_key"),
        msg.message_id(instance, lead, channel, event).alias("message_id"),
        inst.lead_type(lead).alias("lead_type"),
        inst.channel_name(channel).alias("channel_name"),
        inst.line_number(line).cast("bigint").alias("line_number"),
    )


def _user_messages(spark, folder) -> DataFrame:
    """Chunk messages with one signal per user; two neighbouring users are the two channels of a product."""
    user = F.col("user_id")
    first_seen = table(spark, folder, "events").groupBy("user_id").agg(F.min("ts").cast("timestamp").alias("event_time"))
    instance = F.concat(F.lit("product_"), seg.whole_division(user, 2).cast("string"))
    items = first_seen.select(
        "user_id",
        "event_time",
        instance.alias("product_instance_id"),
        instance.alias("original_product_instance_id"),
        instance.alias("product_id"),
        paths.line_id(user % 4 + 1).alias("line_id"),
        (user % 4 + 1).cast("int").alias("line_number"),
        F.date_format("event_time", "yyyyMMdd").alias("batch_id"),
        user.cast("string").alias("sequence_id"),
        (seg.whole_division(user, 2) % 16 + 1).cast("int").alias("lead_num"),
        (user % 2).cast("int").alias("channel"),
        F.format_string("user_%d.csv", user).alias("file_name"),
        F.lit(False).alias("is_duplicate"),
        F.lit(0).alias("replay_iteration"),
    )
    return mops.build_messages(_event_chunks(spark, folder).join(items, "user_id"))


def message_json(spark, folder):
    """Messages written as JSON and read back."""
    rows = mops.keyed_json(_user_messages(spark, folder), "raw").select("key", "value")
    total = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v)
    numbers = ["lead_num", "channel", "chunk_index", "total_chunks", "start_sample", "end_sample", "sample_rate_hz"]
    return mops.parse_messages(rows).select(
        "key", "message_id", "line_id", "lead_type", "channel_name", "event_time", "is_last_chunk",
        *whole(*numbers),
        "metadata.file_name", "metadata.is_duplicate",
        F.size("samples").cast("bigint").alias("samples"),
        F.round(total, 2).alias("total_value"),
    )


def _event_messages(spark, folder) -> DataFrame:
    return _messages_of_events(table(spark, folder, "events"))


def _messages_of_events(events: DataFrame) -> DataFrame:
    """One message per event; those of type 'error' count as replays."""
    event, user = F.col("event_id"), F.col("user_id")
    instance = F.concat(F.lit("event_"), event.cast("string"))
    rows = events.select(
        "event_id",
        instance.alias("product_instance_id"),
        instance.alias("original_product_instance_id"),
        instance.alias("product_id"),
        paths.line_id(user % 4 + 1).alias("line_id"),
        (user % 4 + 1).cast("int").alias("line_number"),
        F.date_format("ts", "yyyyMMdd").alias("batch_id"),
        event.cast("string").alias("sequence_id"),
        (event % 16 + 1).cast("int").alias("lead_num"),
        (event % 2).cast("int").alias("channel"),
        F.lit(0).alias("chunk_index"),
        F.lit(1).alias("total_chunks"),
        F.lit(True).alias("is_last_chunk"),
        F.lit(0).alias("start_sample"),
        F.lit(1).alias("end_sample"),
        F.array("value").alias("samples"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.format_string("event_%d.csv", event).alias("file_name"),
        (F.col("event_type") == "error").alias("is_duplicate"),
        F.lit(0).alias("replay_iteration"),
    )
    return mops.build_messages(rows)


def _faulty_json(spark, folder) -> DataFrame:
    """The event messages as text, each with the fault its event id assigns; the first of ten kinds is none."""
    rows = mops.keyed_json(_event_messages(spark, folder), "raw")
    rows = settled(rows, event_id=F.regexp_extract("key", "event_([0-9]+)", 1).cast("bigint"))
    text, event = F.col("value"), F.col("event_id")
    faults = [
        text,
        F.replace(text, F.lit('"message_id"'), F.lit('"other_id"')),
        F.regexp_replace(text, '"lead_num":[0-9]+', '"lead_num":17'),
        F.regexp_replace(text, '"channel":[0-9]', '"channel":2'),
        F.replace(text, F.lit('"sample_rate_hz":25000'), F.lit('"sample_rate_hz":1000')),
        F.replace(text, F.lit('"chunk_index":0'), F.lit('"chunk_index":"x"')),
        F.concat(F.lit("broken "), text),
        F.regexp_replace(text, '"event_time":"[^"]*"', '"event_time":"yesterday"'),
        F.replace(text, F.lit('"is_duplicate"'), F.lit('"was_duplicate"')),
        F.replace(text, F.lit('"chunk_index":0'), F.lit('"chunk_index":1.5')),
    ]
    return rows.select(event.alias("event_id"), pick(event, faults).alias("value"))


def validate_messages(spark, folder):
    checked = mops.check_messages(_faulty_json(spark, folder))
    return checked.select("event_id", F.array_join("errors", ",").alias("errors"))


def route_messages(spark, folder):
    checked = written(mops.check_messages(_faulty_json(spark, folder)), "checked")
    valid = mops.valid_messages(checked).select(F.lit("valid").alias("route"), F.lit("").alias("first_error"))
    dead = mops.dead_letters(checked).select(F.lit("dead").alias("route"), F.get("errors", F.lit(0)).alias("first_error"))
    return valid.unionByName(dead).groupBy("route", "first_error").agg(F.count("*").alias("messages"))


def exclude_replays(spark, folder):
    return mops.without_replays(_event_messages(spark, folder)).select("message_id", "line_id", "event_time")


def dedup_messages(spark, folder):
    messages = _event_messages(spark, folder)
    repeated = messages.unionByName(messages.filter("metadata.is_duplicate"))
    once = mops.drop_repeats(repeated)
    return once.select("message_id", "line_id", F.get("samples", F.lit(0)).alias("sample"))


def _chunks_with_gaps(spark, folder) -> DataFrame:
    """The event chunks as a store holds them, some of them lost on the way."""
    lost = (F.col("user_id") + F.col("chunk_index")) % 7 == 0
    return written(_event_chunks(spark, folder).filter(~lost), "chunks")


def chunk_completeness(spark, folder):
    done = ch.chunk_completeness(_chunks_with_gaps(spark, folder), ["user_id"])
    return done.select("user_id", *whole("total_chunks", "received_chunks", "n"), "is_complete")


def reassemble(spark, folder):
    samples = ch.reassemble(_chunks_with_gaps(spark, folder), ["user_id"])
    return samples.select("user_id", *whole("pos", "n"), "value")


def missing_chunks(spark, folder):
    missing = ch.missing_chunks(_chunks_with_gaps(spark, folder), ["user_id"])
    return missing.select("user_id", *whole("total_chunks", "chunk_index"))


def channel_presence(spark, folder):
    lost = (F.col("lead_num") + F.col("channel") + F.col("chunk_index")) % 7 == 0
    arrived = _user_messages(spark, folder).filter(~lost)  # only their keys are read
    complete = ch.chunk_completeness(arrived, mops.SIGNAL_KEY).filter("is_complete")
    present = mops.channel_presence(complete)
    return present.select("product_instance_id", *whole("lead_num"), "has_channel_0", "has_channel_1", "has_both")


def latest_per_key(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    latest = mops.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", "value")


# --- tables


def _summary_versions(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Summaries per (user, type), and a later run: the clicks judged more strictly, plus a row for all types."""
    keys = ["user_id", "event_type"]
    first = signal_summary(segment_stats(event_samples(spark, folder, *keys), keys), keys)
    clicks = table(spark, folder, "events").filter("event_type = 'click'")
    order, value = [F.col("event_id")], F.col("value")
    strict = samples_from_rows(clicks, {k: F.col(k) for k in keys}, order, value)
    total = samples_from_rows(
        table(spark, folder, "events"), {"user_id": F.col("user_id"), "event_type": F.lit("all")}, order, value
    )
    both = [signal_summary(segment_stats(s, keys), keys, 0.1) for s in (strict, total)]
    return first, both[0].unionByName(both[1])


def _versions_report(df: DataFrame) -> DataFrame:
    return df.select("user_id", "event_type", *whole("total_samples"), rounded("cpd_score"), "quality_decision")


def upsert_by_key_summary(spark, folder):
    first, later = _summary_versions(spark, folder)
    return _versions_report(upsert_by_key(first, later, ["user_id", "event_type"]))


def upsert_table_rerun(spark, folder):
    """The later run judges the clicks of even users only. Clicks are stored under NULL, a partition like any other."""
    path = fresh_path(spark, "upsert")
    first, later = _summary_versions(spark, folder)
    later = later.filter("event_type <> 'click' OR user_id % 2 = 0")
    first, later = (written(v.withColumn("event_type", F.nullif("event_type", F.lit("click"))), "version") for v in (first, later))
    for version in (first, later, later):
        upsert_table(version, path, ["user_id", "event_type"], ["event_type"])
    return _versions_report(spark.read.parquet(path))


def append_partitioned_rerun(spark, folder):
    path = fresh_path(spark, "append")
    keys = ["user_id", "day"]
    summary = signal_summary(segment_stats(event_samples(spark, folder, *keys), keys), keys)
    rows = summary.select(F.col("day").alias("event_date"), (F.col("user_id") % 4).alias("line_number"), "total_samples")
    rows = written(rows, "rows")
    for _ in range(2):
        append_partitioned(rows, path)
    back = spark.read.parquet(path)
    return back.groupBy("event_date", F.col("line_number").cast("bigint").alias("line_number")).agg(
        F.count("*").alias("rows"), F.sum("total_samples").alias("samples")
    )


# --- signal files that Spark writes from the events


def _event_tree(spark, folder) -> str:
    """CSV signals of bounded length: one per event type and million events, in event order."""
    path = fresh_path(spark, "signals")
    block = seg.whole_division(F.col("event_id"), 1_000_000)
    (
        table(spark, folder, "events")
        .select("event_type", block.alias("block"), "event_id", "value")
        .repartition("event_type", "block")
        .sortWithinPartitions("event_type", "block", "event_id")
        .write.option("header", True)
        .partitionBy("event_type", "block")
        .csv(path)
    )
    return path


def csv_batch_segments(spark, folder):
    source = SignalFiles(spark, _event_tree(spark, folder))
    rows = segment_rows(source, "00000000-0000-0000-0000-000000000001", "2024-01-01T10:20:30Z")
    kind = F.regexp_extract("source_file", "event_type=([^/]+)/", 1).alias("event_type")
    block = F.regexp_extract("source_file", "block=([0-9]+)/", 1).cast("bigint").alias("block")
    return rows.select(
        kind, block, *whole("segment_index"), "parity_group", *whole("parity_order", "sample_count"), *measures()
    )


def csv_batch_summary(spark, folder):
    source = SignalFiles(spark, _event_tree(spark, folder))
    rows = segment_rows(source, "00000000-0000-0000-0000-000000000001", "2024-01-01T10:20:30Z")
    kind = F.regexp_extract("source_file", "event_type=([^/]+)/", 1).alias("event_type")
    block = F.regexp_extract("source_file", "block=([0-9]+)/", 1).cast("bigint").alias("block")
    window = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")]
    return summary_rows(rows).select(
        "run_id", kind, block, *whole("record_count", "total_samples"), *scores(), "quality_decision", *window
    )


# --- streams over the same data


def _run(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_hourly(spark, folder):
    out, checkpoint = fresh_path(spark, "hourly"), fresh_path(spark, "stream")
    decision = seg.quality_decision(F.col("value"), 100.0).alias("quality_decision")

    def decided(events):
        return events.select(F.col("ts").cast("timestamp").alias("event_time"), decision)

    stored = table(spark, folder, "events")
    events = spark.readStream.schema(stored.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    hours = message_streams.hourly_decisions(decided(events))
    _run(message_streams.append_to_files(hours, out, checkpoint, available_now=True))
    emitted = spark.read.parquet(out)
    hours = emitted.unionByName(message_streams.open_hours(decided(stored), emitted))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return hours.select(
        *[F.date_format(c, pattern).alias(c) for c in ("window_start", "window_end")], "quality_decision", "signals"
    )


def stream_route(spark, folder):
    raw, valid, dead = (fresh_path(spark, n) for n in ("raw", "valid", "dead"))
    _faulty_json(spark, folder).select(F.lit("raw").alias("topic"), F.lit(None).cast("string").alias("key"), "value").write.json(raw)
    source = stream_message_files(spark, raw)
    _run(message_streams.route_messages(source, valid, dead, fresh_path(spark, "stream"), available_now=True))
    ok = spark.read.parquet(valid).select(F.lit("valid").alias("route"), F.lit("").alias("first_error"))
    bad = spark.read.parquet(dead).select(F.lit("dead").alias("route"), F.get("errors", F.lit(0)).alias("first_error"))
    return ok.unionByName(bad).groupBy("route", "first_error").agg(F.count("*").alias("messages"))


def _stored_stream(spark, folder):
    """Path of the valid messages of all users, each twice, and the same as a stream of complete and incomplete signals.

    Every fifth user loses chunks on the way.
    """
    raw, valid, dead = (fresh_path(spark, n) for n in ("raw", "valid", "dead"))
    user = F.regexp_extract("metadata.file_name", "user_([0-9]+)", 1).cast("bigint")
    arrived = _user_messages(spark, folder).filter(~((user % 5 == 0) & ((user + F.col("chunk_index")) % 7 == 0)))
    rows = mops.keyed_json(arrived, "raw").drop("chunk_index")
    rows.unionByName(rows).write.json(raw)
    source = stream_message_files(spark, raw)
    _run(message_streams.route_messages(source, valid, dead, fresh_path(spark, "stream"), available_now=True))
    stored = spark.readStream.schema(spark.read.parquet(valid).schema).parquet(valid)
    return valid, message_streams.signal_completeness(message_streams.once_each(stored, "1 minute"))


def stream_presence(spark, folder):
    """Whether both channels of a lead came on the same day, by a stream and its closing step."""
    valid, complete = _stored_stream(spark, folder)
    out = fresh_path(spark, "presence")
    leads = message_streams.lead_presence(complete)
    _run(message_streams.append_to_files(leads, out, fresh_path(spark, "stream"), available_now=True))
    found = spark.read.schema(leads.schema).parquet(out).unionByName(message_streams.open_leads(spark, valid, out))
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return found.select(day, "product_instance_id", *whole("lead_num"), "has_channel_0", "has_channel_1", "has_both")


def stream_topics(spark, folder):
    """Feature and decision messages of the judged signals, as a stream and its closing step send them."""
    valid, complete = _stored_stream(spark, folder)
    out, lost, sent = (fresh_path(spark, n) for n in ("scores", "lost", "sent"))
    send = message_streams.topic_files(sent, "features", "decisions")
    checkpoint = fresh_path(spark, "stream")
    _run(message_streams.score_signals(complete, valid, out, checkpoint, available_now=True, lost_path=lost, send=send))
    message_streams.close_signals(spark, valid, out, lost, send=send)
    messages = spark.read.schema("key string, value string, batch_id string, topic string").json(sent)
    fields = F.from_json("value", "total_samples bigint, odd_even_gap double, cpd_score double, quality_decision string").alias("v")
    told = messages.select("topic", "key", fields).select("topic", "key", "v.*")
    return told.select("topic", "key", "total_samples", rounded("odd_even_gap", 8), rounded("cpd_score"), "quality_decision")


def stream_late(spark, folder):
    """Messages of events that come in four deliveries; every fiftieth is held back until the last one.

    What is older than the deliveries before by more than ten minutes is kept as late.
    """
    raw, valid, dead, late, bounds = (fresh_path(spark, n) for n in ("raw", "valid", "dead", "late", "bounds"))
    checkpoint = fresh_path(spark, "stream")
    events = table(spark, folder, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    regular = seg.whole_division(F.col("event_id") * 4, last + 1)
    delivery = F.when(F.col("event_id") % 50 == 0, 3).otherwise(regular)
    # A delivery lies in few pieces of the table, so its events are dealt out while they are still short.
    tasks = 2 * spark.sparkContext.defaultParallelism
    for number in range(4):
        delivered = events.filter(delivery == number).repartition(tasks, "event_id")
        rows = mops.keyed_json(_messages_of_events(delivered), "raw")
        rows.select("topic", "key", "value").write.mode("append").json(raw)
        source = stream_message_files(spark, raw)
        _run(message_streams.route_messages(source, valid, dead, checkpoint, available_now=True, late=(late, bounds)))
    found = spark.read.parquet(late)
    event = F.regexp_extract("product_instance_id", "event_([0-9]+)", 1).cast("bigint").alias("event_id")
    return found.select(event, F.date_format("bound", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("bound"), "reason")


def stream_scores(spark, folder):
    """Messages of all users, twice each, through routing, repeat removal, completeness, scoring and closing.

    Every fifth user loses chunks on the way; such signals come out as incomplete.
    """
    raw, valid, dead, out, lost = (fresh_path(spark, n) for n in ("raw", "valid", "dead", "scores", "lost"))
    user = F.regexp_extract("metadata.file_name", "user_([0-9]+)", 1).cast("bigint")
    arrived = _user_messages(spark, folder).filter(~((user % 5 == 0) & ((user + F.col("chunk_index")) % 7 == 0)))
    rows = mops.keyed_json(arrived, "raw").drop("chunk_index")
    rows.unionByName(rows).write.json(raw)
    source = stream_message_files(spark, raw)
    _run(message_streams.route_messages(source, valid, dead, fresh_path(spark, "stream"), available_now=True))
    stored = spark.readStream.schema(spark.read.parquet(valid).schema).parquet(valid)
    complete = message_streams.signal_completeness(message_streams.once_each(stored, "1 minute"))
    checkpoint = fresh_path(spark, "stream")
    _run(message_streams.score_signals(complete, valid, out, checkpoint, available_now=True, lost_path=lost))
    message_streams.close_signals(spark, valid, out, lost)
    key = ["product_instance_id", *whole("lead_num", "channel")]
    scored = spark.read.parquet(out).select(*key, *whole("record_count", "total_samples"), *scores(), "quality_decision")
    gaps = spark.read.parquet(lost).groupBy(*mops.SIGNAL_KEY).agg(F.sum(F.size("missing")).alias("missing"))
    incomplete = gaps.select(*key, F.lit("INCOMPLETE").alias("quality_decision"), "missing")
    return scored.withColumn("missing", F.lit(0).cast("bigint")).unionByName(incomplete, allowMissingColumns=True)


# --- drift


def drift_cusum(spark, folder):
    found = drift.cusum(event_samples(spark, folder, "user_id"), ["user_id"], 5.0, 400.0)
    return found.select("user_id", rounded("cusum_high"), rounded("cusum_low"), "first_alarm")


def drift_ks(spark, folder):
    """Odd against even segments of every user's signal."""
    samples = event_samples(spark, folder, "user_id")
    odd = seg.segment_index(F.col("pos"), F.col("n"), 16) % 2 == 1
    return drift.ks_distance(samples, ["user_id"], odd).select("user_id", "n_first", "n_second", rounded("ks", 8))


def baselines(spark, folder):
    """Baselines per event type after three runs, of which the last one knows no errors."""
    keys = ["event_type"]
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    part = F.col("event_id") % 3
    known = drift.moments(events.filter((part == 0) & (F.col("event_type") != "view")), keys)
    for run in (1, 2):
        rows = events.filter((part == run) & ((F.col("event_type") != "error") | (part == 1)))
        known = written(drift.updated_baselines(known, drift.moments(rows, keys), keys), "baselines")
    return known.select("event_type", "n", rounded("mean", 8), F.round(F.sqrt(F.col("m2") / F.col("n")), 6).alias("deviation"))


def drift_ewma(spark, folder):
    found = drift.ewma(event_samples(spark, folder, "user_id"), ["user_id"], 0.2, 2.7)
    return found.select("user_id", rounded("ewma_high"), rounded("ewma_low"), rounded("ewma_last"), "first_alarm")


def change_points(spark, folder):
    """Pieces of every user's signal, cut at borders of 32 cells."""
    found = cp.pieces(event_samples(spark, folder, "user_id"), ["user_id"], penalty=1.0, cells=32)
    return found.select("user_id", "piece", "start_pos", "n", rounded("mean"))


def daily_summary(spark, folder):
    """Daily figures after two runs that append and one that judges every fifth user again, some of them on another line."""
    scored = signal_summary(segment_stats(event_samples(spark, folder, "user_id", "day"), ["user_id", "day"]), ["user_id", "day"])
    user = F.col("user_id")
    rows = scored.select(
        "user_id",
        pick(user, [F.lit("a"), F.lit("b"), F.lit("b")]).alias("run_id"),
        F.concat_ws("/", "day", user.cast("string")).alias("source_file"),
        F.lit(0).alias("channel"),
        F.col("day").alias("event_date"),
        (user % 4).alias("line_number"),
        F.timestamp_seconds(F.lit(0)).alias("processed_at"),
        "cpd_score",
        "quality_decision",
    )
    rows = written(rows, "judged")
    first, second = rows.filter("run_id = 'a'"), rows.filter("run_id = 'b'")
    known = written(daily.daily_summary(first), "daily")
    summary = first.unionByName(second)
    known = written(daily.updated_daily(known, summary, daily.touched_days(second)), "daily")
    half = F.col("cpd_score") / 2
    again = summary.filter("user_id % 5 = 0").withColumns(
        {
            "cpd_score": half,
            "quality_decision": seg.quality_decision(half, 0.2),
            "line_number": F.when(user % 10 == 0, 4).otherwise(F.col("line_number")),
            "processed_at": F.timestamp_seconds(F.lit(60)),
        }
    )
    after = written(upsert_by_key(summary, again, ["run_id", "source_file", "channel"]), "summary")
    known = daily.updated_daily(known, after, daily.touched_days(again, summary))
    scores_of_day = [rounded(c) for c in ("review_share", "mean_score", "max_score")]
    return known.select("event_date", *whole("line_number", "files", "reviews"), *scores_of_day)


def broker_partitions(spark, folder):
    """Key, hash and partition, of 12, in which a broker's own client puts the message of an event."""
    keyed = settled(partition_keys(spark, folder), hash=msg.key_hash(F.col("partition_key")))
    partition = msg.broker_partition(F.col("partition_key"), 12).cast("bigint")
    return keyed.select("event_id", "partition_key", "hash", partition.alias("partition"))


def message_types(spark, folder):
    """Event messages whose text fields hold other JSON values, by event id: none, a number, a truth value, an object."""
    rows = mops.keyed_json(_event_messages(spark, folder), "raw")
    rows = settled(rows, event_id=F.regexp_extract("key", "event_([0-9]+)", 1).cast("bigint"))
    text = F.col("value")
    faults = [
        text,
        F.regexp_replace(text, '"message_id":"[^"]*"', '"message_id":5'),
        F.regexp_replace(text, '"line_id":"[^"]*"', '"line_id":true'),
        F.regexp_replace(text, '"file_name":"[^"]*"', '"file_name":{"name":"x"}'),
        F.regexp_replace(text, '"product_id":"[^"]*"', '"product_id":null'),
        F.regexp_replace(text, '"batch_id":"([^"]*)"', '"batch_id":$1'),
    ]
    checked = mops.check_messages(rows.select("event_id", pick(F.col("event_id"), faults).alias("value")))
    return checked.select("event_id", F.array_join("errors", ",").alias("errors"))


# --- the jobs as a whole


def csv_split_change(spark, folder):
    """Samples of signal files when later scans would be cut otherwise than the first one."""
    source = SignalFiles(spark, _event_tree(spark, folder))
    name = "spark.sql.leafNodeDefaultParallelism"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "2")
        samples = source.samples
        spark.conf.set(name, "8")
        named = written(source.named(samples), "samples")
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    kind = F.regexp_extract("source_file", "event_type=([^/]+)/", 1).alias("event_type")
    return named.select(kind, *whole("pos", "n"), "value")


def key_order(spark, folder):
    """Messages as a broker gets them: the place of each among its key's rows in its partition, and who else has the key."""
    rows = mops.by_key_in_order(mops.keyed_json(_user_messages(spark, folder), "raw"))
    placed = rows.select("key", "chunk_index", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id"))
    placed = written(placed, "sent")
    own = Window.partitionBy("key", "part").orderBy("id")
    parts = placed.groupBy("key").agg(F.count_distinct("part").alias("partitions"))
    return placed.withColumn("place", F.row_number().over(own) - 1).join(parts, "key").select(
        "key", *whole("chunk_index", "place", "partitions")
    )


def _product_tree(spark, folder) -> str:
    """Signal files of products in event order: two users are the two channels of one, products are of three days."""
    target = fresh_path(spark, "tree")
    user, battery = F.col("user_id"), seg.whole_division(F.col("user_id"), 2)
    day, side = F.format_string("2024010%d", battery % 3 + 1), F.when(user % 2 == 0, "reflect").otherwise("out")
    name = F.concat(F.lit("battery_"), F.coalesce(battery.cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")), F.lit(".csv"))
    rows = table(spark, folder, "events").select(
        F.concat_ws("/", day, side, name).alias("file"), "event_id", F.to_csv(F.struct("event_id", "value")).alias("line")
    )
    write_line_files(rows, target, ["event_id"], "event_id,value")
    return target


def _published(spark, folder, **choice) -> DataFrame:
    scan = InstanceScan(spark, _product_tree(spark, folder))
    out = fresh_path(spark, "messages")
    write_message_files(plan_messages(scan, plan_items(scan, **choice), CHUNK), out, "raw")
    rows = spark.read.schema("topic string, key string, value string").json(out)
    total = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v)
    return mops.parse_messages(rows).select(
        "key", "product_instance_id", "product_id", "line_id",
        *whole("channel", "lead_num", "chunk_index", "total_chunks", "start_sample"), "is_last_chunk",
        "metadata.is_duplicate",
        F.size("samples").cast("bigint").alias("samples"),
        F.round(total, 1).alias("total_value"),
    )


def publish_messages(spark, folder):
    """The publish job over a tree of signal files, its messages written and read back."""
    return _published(spark, folder)


def publish_oldest_date(spark, folder):
    """The same for the products of the oldest day only."""
    return _published(spark, folder, oldest_date_only=True)


def _batch_tree(spark, folder) -> str:
    tree = _product_tree(spark, folder)
    write_bytes(spark, f"{tree}/20240101/out/7_empty_laser_a.csv", b"value\n")
    write_bytes(spark, f"{tree}/20240101/out/7_broken_laser_a.csv", b"1\n\xff2\n")
    write_bytes(spark, f"{tree}/20249999_battery_5000_laser_a.csv", b"value\n1\n3\n")
    return tree


def batch_job_run(spark, folder):
    """The batch job over a tree with odd files among its signals: its summary, and what its run row says."""
    out = fresh_path(spark, "batch")
    run = run_batch(spark, _batch_tree(spark, folder), out, run_id="00000000-0000-0000-0000-000000000001")
    columns = ["file_name", "event_date", "line_id", "product_id", *whole("line_number", "channel", "record_count", "total_samples")]
    summary = spark.read.parquet(f"{out}/summary").withColumn("file_name", paths.file_name(F.col("source_file")))
    runs = spark.read.parquet(f"{out}/runs").filter(F.col("run_id") == run.run_id)
    counts = whole("total_files", "total_segment_rows", "total_summary_rows")
    return summary.select(*columns, rounded("cpd_score"), "quality_decision", "run_id").join(
        runs.select("run_id", "status", *counts), "run_id"
    )


def batch_job_skipped(spark, folder):
    """Files of that tree that give no samples or no date, with the reason."""
    source = SignalFiles(spark, _batch_tree(spark, folder))
    return source.quarantine.select(paths.file_name(F.col("source_file")).alias("file_name"), "reason")


def incomplete_signals(spark, folder):
    """Signals with lost chunks and with repeats, a repeat in place of each lost one, and the indexes that are missing."""
    chunks = _chunks_with_gaps(spark, folder)
    repeated = chunks.unionByName(chunks.filter(F.col("chunk_index") % 3 == 0))
    gaps = ch.incomplete_signals(repeated, ["user_id"])
    missing = F.array_join(F.transform(F.array_sort("missing"), lambda i: i.cast("string")), ",").alias("missing")
    return gaps.select("user_id", *whole("total_chunks", "received_chunks"), missing)


QUERIES = {
    "segment_stats": segment_stats_by_user,
    "segment_stats_short": segment_stats_short,
    "segment_stats_lineitem": segment_stats_lineitem,
    "segment_stats_embeddings": segment_stats_embeddings,
    "signal_summary": summary_by_user_and_type,
    "signal_summary_short": summary_short,
    "signal_summary_lineitem": summary_lineitem,
    "quality_gate": quality_gate,
    "parity_pivot": parity_pivot,
    "hour_window": hour_window,
    "oldest_date": oldest_date,
    "top_paths": top_paths,
    "batch_file_metadata": batch_file_metadata,
    "instance_file_metadata": instance_file_metadata,
    "parse_event_lines": parse_event_lines,
    "parse_document_lines": parse_document_lines,
    "product_instances": product_instances,
    "channel_pairing": channel_pairing,
    "signal_files": signal_files,
    "missing_channels": missing_channels,
    "instance_completeness": instance_completeness,
    "only_complete": only_complete,
    "replay_expand": replay_expand,
    "replay_to_target": replay_to_target,
    "replay_one_line": replay_one_line,
    "replay_seeded": replay_seeded,
    "seeded_order": seeded_order,
    "dry_run_summary": dry_run_summary,
    "chunk_events": chunk_events,
    "chunk_lineitem": chunk_lineitem,
    "chunk_embeddings": chunk_embeddings,
    "partition_keys": partition_keys,
    "message_json": message_json,
    "validate_messages": validate_messages,
    "route_messages": route_messages,
    "exclude_replays": exclude_replays,
    "dedup_messages": dedup_messages,
    "chunk_completeness": chunk_completeness,
    "reassemble": reassemble,
    "missing_chunks": missing_chunks,
    "channel_presence": channel_presence,
    "latest_per_key": latest_per_key,
    "upsert_by_key": upsert_by_key_summary,
    "upsert_table_rerun": upsert_table_rerun,
    "append_partitioned_rerun": append_partitioned_rerun,
    "csv_batch_segments": csv_batch_segments,
    "csv_batch_summary": csv_batch_summary,
    "csv_split_change": csv_split_change,
    "key_order": key_order,
    "publish_messages": publish_messages,
    "publish_oldest_date": publish_oldest_date,
    "batch_job_run": batch_job_run,
    "batch_job_skipped": batch_job_skipped,
    "incomplete_signals": incomplete_signals,
    "stream_hourly": stream_hourly,
    "stream_route": stream_route,
    "stream_scores": stream_scores,
    "stream_presence": stream_presence,
    "stream_topics": stream_topics,
    "stream_late": stream_late,
    "drift_cusum": drift_cusum,
    "drift_ks": drift_ks,
    "baselines": baselines,
    "drift_ewma": drift_ewma,
    "change_points": change_points,
    "daily_summary": daily_summary,
    "broker_partitions": broker_partitions,
    "message_types": message_types,
}
