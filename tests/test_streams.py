"""Message checks, and streams that must give what the batch operators give."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sigloom.operators.chunks import chunk_samples
from sigloom.operators.messages import (
    SIGNAL_KEY, build_messages, check_messages, dead_letters, drop_repeats, keyed_json, latest_per_key, valid_messages,
    without_replays,
)
from sigloom.operators.segments import segment_stats, signal_summary
from sigloom.sources.messages import stream_message_files
from sigloom.streaming import message_streams

GOOD = {
    "message_id": "i:L01:LB:000000", "product_instance_id": "i", "product_id": "p", "line_id": "LINE_01", "lead_num": 1,
    "lead_type": "AL_CU", "channel": 0, "chunk_index": 0, "total_chunks": 1, "is_last_chunk": True, "sample_rate_hz": 25000,
    "samples": [0.5, 1], "event_time": "2022-04-17T00:04:42Z",
    "metadata": {
        "source": "s", "version": "v1", "file_name": "f", "original_product_instance_id": "i", "is_duplicate": False,
        "replay_iteration": 0,
    },
}


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


@pytest.mark.parametrize(
    "text, errors",
    [
        (json.dumps(GOOD), []),
        (json.dumps(GOOD | {"channel_name": "LaserB", "start_sample": 0, "batch_id": None}), []),
        (json.dumps(GOOD | {"samples": []}), []),
        (json.dumps(without("message_id")), ["missing:message_id"]),
        (json.dumps(GOOD | {"lead_num": 17}), ["range:lead_num"]),
        (json.dumps(GOOD | {"lead_num": 0, "lead_type": "CU_AL"}), ["range:lead_num", "enum:lead_type"]),
        (json.dumps(GOOD | {"channel": 2}), ["enum:channel"]),
        (json.dumps(GOOD | {"channel_name": "LaserC"}), ["enum:channel_name"]),
        (json.dumps(GOOD | {"sample_rate_hz": 1000}), ["const:sample_rate_hz"]),
        (json.dumps(GOOD | {"chunk_index": -1}), ["range:chunk_index"]),
        (json.dumps(GOOD | {"total_chunks": 0}), ["range:total_chunks"]),
        (json.dumps(GOOD | {"chunk_index": "x"}), ["unreadable"]),
        (json.dumps(GOOD | {"chunk_index": 1.5}), ["unreadable"]),
        (json.dumps(GOOD | {"samples": [1, None]}), ["type:samples"]),
        (json.dumps(GOOD | {"event_time": "2022-04-17"}), ["format:event_time"]),
        (json.dumps(GOOD | {"event_time": "2022-13-17T00:00:00Z"}), ["format:event_time"]),
        (json.dumps(GOOD | {"metadata": {k: v for k, v in GOOD["metadata"].items() if k != "version"}}),
         ["missing:metadata.version"]),
        (json.dumps(without("metadata")), ["missing:metadata"]),
        ("not json", ["unreadable"]),
    ],
)
def test_contract(spark, text, errors):
    checked = check_messages(spark.createDataFrame([(text,)], "value STRING"))
    assert checked.first().errors == errors
    assert valid_messages(checked).count() == (not errors)
    assert [tuple(r) for r in dead_letters(checked).collect()] == ([(text, errors)] if errors else [])


def test_empty_texts_are_dead_letters(spark):
    checked = check_messages(spark.createDataFrame([(None,), ("",)], "value STRING"))
    assert dead_letters(checked).count() == 2


def test_json_is_parsed_once(spark):
    checked = check_messages(spark.createDataFrame([("{}",)], "value STRING"))
    plan = dead_letters(checked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_latest_and_replays(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "w")]
    df = spark.createDataFrame(rows, "k STRING, o INT, v STRING")
    assert sorted(map(tuple, latest_per_key(df, ["k"], ["o"]).collect()), key=str) == [("a", 3, "y"), (None, 1, "w")]
    flagged = df.select(F.struct((F.col("o") > 1).alias("is_duplicate")).alias("metadata"))
    assert without_replays(flagged).count() == 2


def messages(spark, signals, size=4):
    """Messages of {(instance, channel): (values, event time)}."""
    rows = [
        (instance, channel, pos, len(values), float(v), time)
        for (instance, channel), (values, time) in signals.items()
        for pos, v in enumerate(values)
    ]
    samples = spark.createDataFrame(
        rows, "product_instance_id STRING, channel INT, pos BIGINT, n BIGINT, value DOUBLE, event_time TIMESTAMP"
    )
    chunks = chunk_samples(samples, ["product_instance_id", "channel", "event_time"], size)
    return build_messages(
        chunks.withColumns(
            {
                "original_product_instance_id": F.col("product_instance_id"),
                "product_id": F.lit("p"),
                "line_id": F.lit("LINE_01"),
                "line_number": F.lit(1),
                "batch_id": F.lit("b"),
                "sequence_id": F.lit("s"),
                "lead_num": F.lit(1),
                "file_name": F.lit("f.csv"),
                "is_duplicate": F.lit(False),
                "replay_iteration": F.lit(0),
            }
        )
    )


def at(minute):
    return dt.datetime(2022, 4, 17, 0, minute)


SIGNALS = {
    ("i1", 0): (range(20), at(0)),
    ("i1", 1): (range(7, 20), at(0)),
    ("i2", 0): ([3, 1] * 9, at(1)),
    ("last", 0): ([1], at(50)),
}


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def route(spark, tmp_path):
    source = stream_message_files(spark, str(tmp_path / "raw"), max_files_per_trigger=2)
    query = message_streams.route_messages(
        source, str(tmp_path / "valid"), str(tmp_path / "dead"), str(tmp_path / "route"), available_now=True
    )
    finish(query)
    return spark.read.parquet(str(tmp_path / "valid"))


def completeness(spark, tmp_path, delay="10 minutes"):
    valid = str(tmp_path / "valid")
    stored = spark.readStream.schema(spark.read.parquet(valid).schema).parquet(valid)
    return message_streams.signal_completeness(message_streams.once_each(stored, delay))


def test_stream_from_raw_to_scores(spark, tmp_path):
    rows = keyed_json(messages(spark, SIGNALS), "raw").drop("chunk_index")
    lost = rows.filter(~F.col("value").contains("i2:L01:LB:000002"))
    bad = spark.createDataFrame([("raw", "k", "oops")], rows.schema)
    lost.unionByName(lost.limit(3)).unionByName(bad).repartition(5).write.json(str(tmp_path / "raw"))

    valid = route(spark, tmp_path)
    assert drop_repeats(valid).count() == lost.count()
    assert [r.errors for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [["unreadable"]]
    # A second start finds nothing new.
    before = valid.count()
    assert route(spark, tmp_path).count() == before

    stream_args = dict(checkpoint=str(tmp_path / "complete_ck"), available_now=True)
    finish(message_streams.append_to_files(completeness(spark, tmp_path), str(tmp_path / "complete"), **stream_args))
    done = spark.read.parquet(str(tmp_path / "complete")).collect()
    assert sorted((r.product_instance_id, r.channel, r.received_chunks, r.is_complete) for r in done) == [
        ("i1", 0, 5, True), ("i1", 1, 4, True), ("i2", 0, 4, False)
    ]

    finish(
        message_streams.score_signals(
            completeness(spark, tmp_path), str(tmp_path / "valid"), str(tmp_path / "scores"), str(tmp_path / "score_ck"),
            available_now=True,
        )
    )
    scored = spark.read.parquet(str(tmp_path / "scores"))
    flat = [(i, c, p, len(v), float(x)) for (i, c), (v, _) in SIGNALS.items() if i == "i1" for p, x in enumerate(v)]
    batch = signal_summary(
        segment_stats(spark.createDataFrame(flat, "i STRING, c INT, pos BIGINT, n BIGINT, value DOUBLE"), ["i", "c"]), ["i", "c"]
    )
    columns = ["record_count", "total_samples", "odd_pattern_mean", "even_pattern_mean", "cpd_score", "quality_decision"]
    assert sorted(map(tuple, scored.select("product_instance_id", "channel", *columns).collect())) == sorted(
        map(tuple, batch.select("i", "c", *columns).collect())
    )


def test_repeats_within_the_delay_and_late_rows(spark, tmp_path):
    schema = "message_id STRING, event_time TIMESTAMP"
    folder = tmp_path / "in"

    def arrive(number, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"b={number}"))

    def run():
        stream = spark.readStream.schema(schema + ", b INT").parquet(str(folder)).drop("b")
        once = message_streams.once_each(stream, "10 minutes")
        return finish(message_streams.append_to_files(once, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True))

    arrive(1, [("a", at(0)), ("a", at(0)), ("b", at(1))])
    run()
    arrive(2, [("a", at(2)), ("c", at(40))])
    run()
    arrive(3, [("late", at(5)), ("d", at(41))])
    query = run()
    got = sorted(r.message_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["a", "b", "c", "d"]
    assert message_streams.late_rows(query) == 1


def test_topic_per_row(spark):
    rows = spark.createDataFrame([("k1", json.dumps(GOOD)), ("k2", "oops")], "key STRING, value STRING")
    got = {r.key: (r.topic, r.value) for r in message_streams.by_topic(rows, "ok", "dlq").collect()}
    assert got["k1"] == ("ok", json.dumps(GOOD))
    assert got["k2"][0] == "dlq" and json.loads(got["k2"][1]) == {"value": "oops", "errors": ["unreadable"]}


def test_hourly_roll_up_equals_batch(spark, tmp_path):
    rows = [(dt.datetime(2022, 4, 17, h, m), d) for h in range(4) for m, d in ((5, "PASS"), (10, "REVIEW"), (50, "PASS"))]
    spark.createDataFrame(rows, "event_time TIMESTAMP, quality_decision STRING").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_time TIMESTAMP, quality_decision STRING").parquet(str(tmp_path / "in"))
    finish(
        message_streams.append_to_files(
            message_streams.hourly_decisions(stream), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True
        )
    )
    got = sorted((r.window_start.hour, r.quality_decision, r.signals) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # The last hour is still open.
    assert got == [(h, d, n) for h in range(3) for d, n in (("PASS", 2), ("REVIEW", 1))]


def test_signal_key():
    assert SIGNAL_KEY == ["product_instance_id", "lead_num", "channel"]


@pytest.mark.parametrize("files", [1, 100])
def test_presence_does_not_depend_on_batches(spark, tmp_path, files):
    schema = "event_time timestamp, product_instance_id string, lead_num int, channel int, is_complete boolean"
    start = dt.datetime(2024, 1, 1, 8)
    rows = [(start, "a", 1, 0, True), (start + dt.timedelta(hours=3), "a", 1, 1, True), (start, "b", 1, 1, True)]
    rows += [(start, "c", 2, 0, True), (start, "c", 2, 1, False), (start + dt.timedelta(days=3), "z", 1, 0, True)]
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(f"{tmp_path}/in")
    leads = message_streams.lead_presence(stream.withWatermark("event_time", "1 day"))
    query = message_streams.append_to_files(leads, f"{tmp_path}/out", f"{tmp_path}/checkpoint", available_now=True)
    query.awaitTermination()
    found = spark.read.schema(leads.schema).parquet(f"{tmp_path}/out").collect()
    got = {(r.product_instance_id, r.has_channel_0, r.has_channel_1, r.has_both) for r in found}
    assert got == {("a", True, True, True), ("b", False, True, False), ("c", True, False, False)} and len(found) == 3
