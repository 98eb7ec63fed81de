"""Streams of raw messages: a Kafka topic, or JSON files in the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "topic STRING, key STRING, value STRING"


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"} | options
    raw = spark.readStream.format("kafka").options(**settings).load()
    return raw.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def stream_message_files(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(FILE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).json(path)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).json(path)
