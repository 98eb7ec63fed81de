"""The work per message of the late stream: what is kept of checked messages, deliveries spread over tasks."""

import json

from pyspark.sql import functions as F

from sigloom.operators import messages as mops
from sigloom.plans import table_queries
from test_streams import GOOD


def test_raw_texts_are_kept_of_dead_letters_only(spark):
    raw = spark.createDataFrame([(json.dumps(GOOD),), ("oops",)], "value STRING")
    kept = mops.without_read_texts(mops.check_messages(raw))
    assert sorted((r.value or "", len(r.errors)) for r in kept.collect()) == [("", 0), ("oops", 1)]


def test_every_delivery_is_made_by_several_tasks(spark, tmp_path, monkeypatch):
    number = F.col("id")
    events = spark.range(0, 400, 1, 1).select(
        number.alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT))").alias("ts"),
        (number % 3).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(table_queries, "fresh_path", lambda spark, label: str(tmp_path / label))
    late = table_queries.stream_late(spark, str(tmp_path))
    assert sorted(r.event_id for r in late.collect()) == [0, 50, 100, 150, 200, 250]
    event = F.regexp_extract("key", "event_([0-9]+)", 1).cast("bigint")
    sent = spark.read.json(str(tmp_path / "raw")).select(F.floor(event / 100).alias("quarter"), F.input_file_name().alias("file"))
    files = sent.groupBy("quarter").agg(F.count("*").alias("rows"), F.countDistinct("file").alias("files")).collect()
    assert all(r.rows == 100 and r.files > 1 for r in files) and len(files) == 4
