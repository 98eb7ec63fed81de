"""Raw messages -> checked -> once each -> complete signals -> decisions, as streams.

State is kept per message id and per signal as counts, never as samples: the samples of a complete signal are read
back from the table of valid chunks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigloom import fixed_values as fixed
from sigloom.operators.chunks import arrival_counts, chunk_completeness, incomplete_signals, is_complete, reassemble
from sigloom.operators.joins import attach
from sigloom.operators.messages import (
    SIGNAL_KEY,
    check_messages,
    dead_letters,
    drop_repeats,
    valid_messages,
    without_read_texts,
)
from sigloom.operators.segments import segment_stats, signal_summary
from sigloom.shared_storage import delete_path, fresh_path, path_exists, stored, written

DEFAULT_DELAY = "10 minutes"


def _start(stream: DataFrame, checkpoint: str, available_now: bool):
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer


def route_messages(
    raw: DataFrame,
    valid_path: str,
    dead_path: str,
    checkpoint: str,
    available_now: bool = False,
    late: tuple[str, str] | None = None,
    delay: str = DEFAULT_DELAY,
) -> StreamingQuery:
    """Split a raw stream into a table of valid messages, by event date, and one of dead letters.

    Each micro-batch owns a folder and replaces it when it is retried, so a retry adds nothing twice.

    With ``late`` (a folder of rows, a folder of bounds) valid messages that are older than the latest event time of all
    batches before by more than ``delay`` go there, with the bound, instead of to the valid table. A stream that reads
    the valid table with the same delay then drops none: its own watermark follows from no more than these batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Stored instead of cached: smaller, written faster, and no burden on the executors' memory.
        path = fresh_path(batch.sparkSession, "checked")
        try:
            checked = stored(without_read_texts(check_messages(batch)), path)
            valid = valid_messages(checked).withColumn("event_date", F.to_date("event_time"))
            folder = f"batch_id={batch_id}"
            if late is not None:
                valid = _without_late(valid, batch_id, late[0], late[1], delay)
            valid.write.mode("overwrite").partitionBy("event_date").parquet(f"{valid_path}/{folder}")
            dead_letters(checked).write.mode("overwrite").parquet(f"{dead_path}/{folder}")
        finally:
            delete_path(batch.sparkSession, path)

    return _start(raw, checkpoint, available_now).foreachBatch(write).start()


def _without_late(valid: DataFrame, batch_id: int, late_path: str, bounds_path: str, delay: str) -> DataFrame:
    """Writes this batch's late rows and its latest event time, one row per batch, and returns the rest."""
    spark, folder = valid.sparkSession, f"batch_id={batch_id}"
    latest = valid.agg(F.max("event_time").alias("latest"))
    bound = None
    if path_exists(spark, bounds_path):
        before = spark.read.schema("latest timestamp, batch_id long").parquet(bounds_path).filter(F.col("batch_id") < batch_id)
        bound = before.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("bound")).first().bound
    latest.write.mode("overwrite").parquet(f"{bounds_path}/{folder}")
    is_late = F.lit(False) if bound is None else F.col("event_time") < F.lit(bound)
    rows = valid.filter(is_late).withColumn("bound", F.lit(bound).cast("timestamp"))
    rows.withColumn("reason", F.lit("late")).write.mode("overwrite").parquet(f"{late_path}/{folder}")
    return valid.filter(~is_late)


def by_topic(raw: DataFrame, valid_topic: str, dead_topic: str) -> DataFrame:
    """The same split for a keyed broker sink: one stream whose rows name their topic."""
    checked = check_messages(raw.select("key", "value"))
    topic = F.when(F.size("errors") == 0, valid_topic).otherwise(dead_topic)
    reasons = F.to_json(F.struct("value", "errors"))
    return checked.select(
        topic.alias("topic"), "key", F.when(F.size("errors") == 0, F.col("value")).otherwise(reasons).alias("value")
    )


def once_each(messages: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Drop repeats of a message id that arrive within the delay. Later rows than that are dropped as late."""
    return messages.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["message_id"])


def signal_completeness(messages: DataFrame) -> DataFrame:
    """One row per signal once the watermark has passed its time: chunks expected and received.

    All chunks of an instance share their event time, so it groups them and closes the group. The group of the latest
    time stays open until a later one arrives.
    """
    return (
        messages.groupBy("event_time", *SIGNAL_KEY)
        .agg(*arrival_counts())
        .withColumn("is_complete", is_complete())
    )


TIMED_KEY = ["event_time", *SIGNAL_KEY]

#: Takes the summaries of a batch and the batch's name, the same name again when the batch is retried.
Send = Callable[[DataFrame, str], None]


def _write_results(
    signals: DataFrame, chunks: DataFrame, out_path: str, lost_path: str | None, name: str, segments: int, threshold: float, send: Send | None
) -> None:
    """Decisions of the complete ones among ``signals`` (keys, counts, is_complete) and dead letters of the others."""
    complete = signals.filter("is_complete")
    samples = reassemble(drop_repeats(chunks), TIMED_KEY, complete)
    summary = signal_summary(segment_stats(samples, TIMED_KEY, segments), TIMED_KEY, threshold)
    summary.write.mode("overwrite").parquet(f"{out_path}/batch_id={name}")
    if send is not None:
        # Read back, so that sending judges nothing again.
        send(signals.sparkSession.read.schema(summary.schema).parquet(f"{out_path}/batch_id={name}"), name)
    if lost_path is not None:
        lost = attach(drop_repeats(chunks), signals.filter("NOT is_complete").select(*TIMED_KEY), TIMED_KEY, "left_semi")
        incomplete_signals(lost, TIMED_KEY).withColumn("reason", F.lit("incomplete")).write.mode("overwrite").parquet(
            f"{lost_path}/batch_id={name}"
        )


def score_signals(
    completeness: DataFrame,
    valid_path: str,
    out_path: str,
    checkpoint: str,
    segments: int = fixed.SEGMENT_COUNT,
    threshold: float = fixed.DRIFT_THRESHOLD,
    available_now: bool = False,
    lost_path: str | None = None,
    send: Send | None = None,
) -> StreamingQuery:
    """Segment statistics and decisions of the signals that became complete, by the operators of the batch job.

    Signals whose time has passed without all of their chunks go to ``lost_path`` with the missing indexes. Each batch's
    summaries also go through ``send``, such as ``topic_files``, once they are stored.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = batch.persist()
        try:
            # Only the days of this batch are read. They are few: one for each day of event times that it closes.
            days = [r.day for r in closed.select(F.to_date("event_time").alias("day")).distinct().collect()]
            if days:
                chunks = closed.sparkSession.read.parquet(valid_path).filter(F.col("event_date").isin(days))
                chunks = attach(chunks, closed.select(*TIMED_KEY), TIMED_KEY, "left_semi")
                _write_results(closed, chunks, out_path, lost_path, str(batch_id), segments, threshold, send)
        finally:
            closed.unpersist()

    return _start(completeness, checkpoint, available_now).foreachBatch(write).start()


def close_signals(
    spark: SparkSession,
    valid_path: str,
    out_path: str,
    lost_path: str,
    segments: int = fixed.SEGMENT_COUNT,
    threshold: float = fixed.DRIFT_THRESHOLD,
    send: Send | None = None,
) -> None:
    """The closing step when no more messages come: what the stream still holds open is judged from the stored chunks."""
    chunks = spark.read.parquet(valid_path)
    for path in (out_path, lost_path):
        if path_exists(spark, path):
            known = spark.read.parquet(path).filter("CAST(batch_id AS STRING) <> 'closing'").select(*TIMED_KEY).distinct()
            chunks = attach(chunks, known, TIMED_KEY, "left_anti")
    chunks = written(chunks, "open")
    signals = written(chunk_completeness(drop_repeats(chunks), TIMED_KEY), "closing")
    _write_results(signals, chunks, out_path, lost_path, "closing", segments, threshold, send)


def open_hours(decisions: DataFrame, emitted: DataFrame, time: str = "event_time") -> DataFrame:
    """The closing step of the hourly roll-up: hours that the stream never emitted, counted from the stored decisions.

    They are for a table of their own: a stream's output folder lists only what the stream wrote.
    """
    return attach(_per_hour(decisions, time), emitted.select("window_start").distinct(), ["window_start"], "left_anti")


LEAD_KEY = ["window_start", "product_instance_id", "lead_num"]


def _leads(complete: DataFrame, window: str) -> DataFrame:
    arrived = [F.bool_or(F.col("channel") == c).alias(f"has_channel_{c}") for c in (0, 1)]
    return (
        complete.groupBy(F.window("event_time", window).alias("span"), "product_instance_id", "lead_num")
        .agg(*arrived)
        .select(
            F.col("span.start").alias("window_start"), "product_instance_id", "lead_num", "has_channel_0", "has_channel_1",
            (F.col("has_channel_0") & F.col("has_channel_1")).alias("has_both"),
        )
    )


def lead_presence(completeness: DataFrame, window: str = "1 day") -> DataFrame:
    """Whether both channels of a lead came, once the watermark has passed the window of their event times.

    A second stateful step behind ``signal_completeness``: two flags per (window, instance, lead) are its state, so it makes
    no difference in which micro-batches the channels close. The channels of a lead are expected in one window.
    """
    return _leads(completeness.filter("is_complete"), window)


def open_leads(spark: SparkSession, valid_path: str, out_path: str, window: str = "1 day") -> DataFrame:
    """The closing step: leads that the stream never emitted, judged from the stored chunks."""
    signals = chunk_completeness(drop_repeats(spark.read.parquet(valid_path)), TIMED_KEY)
    leads = _leads(signals.filter("is_complete"), window)
    if not path_exists(spark, out_path):
        return leads
    emitted = spark.read.schema(leads.schema).parquet(out_path).select(*LEAD_KEY).distinct()
    return attach(leads, emitted, LEAD_KEY, "left_anti")


def topic_files(path: str, feature_topic: str, decision_topic: str) -> Send:
    """Writes the rows of ``result_topics`` as files, a folder per batch and topic; a retried batch replaces its own."""

    def send(summary: DataFrame, name: str) -> None:
        rows = result_topics(summary, feature_topic, decision_topic)
        rows.write.mode("overwrite").partitionBy("topic").json(f"{path}/batch_id={name}")

    return send


def result_topics(summary: DataFrame, feature_topic: str, decision_topic: str) -> DataFrame:
    """Two rows for a keyed broker sink of each judged signal: its features, and its decision."""
    key = F.concat_ws(":", "product_instance_id", "lead_num", "channel")
    features = F.to_json(F.struct(*SIGNAL_KEY, "event_time", "total_samples", "odd_pattern_mean", "even_pattern_mean", "odd_even_gap"))
    decision = F.to_json(F.struct(*SIGNAL_KEY, "event_time", "cpd_score", "quality_decision"))
    rows = F.array(
        F.struct(F.lit(feature_topic).alias("topic"), features.alias("value")),
        F.struct(F.lit(decision_topic).alias("topic"), decision.alias("value")),
    )
    return summary.select(key.alias("key"), F.explode(rows).alias("r")).select("r.topic", "key", "r.value")


def _per_hour(decisions: DataFrame, time: str) -> DataFrame:
    return (
        decisions.groupBy(F.window(time, "1 hour").alias("hour"), "quality_decision")
        .agg(F.count("*").alias("signals"))
        .select(
            F.col("hour.start").alias("window_start"), F.col("hour.end").alias("window_end"), "quality_decision", "signals"
        )
    )


def hourly_decisions(decisions: DataFrame, time: str = "event_time", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Decisions per hour."""
    return _per_hour(decisions.withWatermark(time, delay), time)


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark has dropped so far: they vanish without an error. ``route_messages`` can keep them instead."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def append_to_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return _start(stream, checkpoint, available_now).format("parquet").option("path", path).outputMode("append").start()
