"""Cut signals into chunks of a fixed number of samples, and put them together again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import messages as msg

# Chunk indexes handled together: with 5,000 samples per chunk, some 20 MB.
BUCKET = 512


def _with_bounds(df: DataFrame, size: int) -> DataFrame:
    index = F.col("chunk_index")
    start, end = msg.chunk_bounds(index, F.col("n"), size)
    total = msg.total_chunks(F.col("n"), size)
    return df.withColumns(
        {
            "total_chunks": total,
            "is_last_chunk": index == total - 1,
            "start_sample": start,
            "end_sample": end,
        }
    )


def chunk_samples(samples: DataFrame, keys: Sequence[str], size: int = fixed.CHUNK_SIZE) -> DataFrame:
    """One row per chunk with its ordered ``samples``. Groups are chunks, so none exceeds ``size`` rows."""
    chunks = (
        samples.withColumn("chunk_index", msg.chunk_index(F.col("pos"), size))
        .groupBy(*keys, "chunk_index")
        .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("__pairs"))
    )
    values = F.transform("__pairs", lambda pair: pair["value"])
    return _with_bounds(chunks.withColumn("samples", values).drop("__pairs"), size).drop("n")


def chunk_arrays(df: DataFrame, array: str, size: int = fixed.CHUNK_SIZE) -> DataFrame:
    """The same for signals that already are array columns: no grouping and no shuffle."""
    n = F.size(array).cast("bigint")
    exploded = (
        df.filter(F.size(array) > 0)
        .withColumn("n", n)
        .withColumn("chunk_index", F.explode(F.sequence(F.lit(0).cast("bigint"), msg.total_chunks(n, size) - 1)))
    )
    taken = F.slice(array, (F.col("chunk_index") * size + 1).cast("int"), F.lit(size))
    chunks = _with_bounds(exploded.withColumn("samples", taken), size)
    return chunks.drop("n", *([] if array == "samples" else [array]))


def arrival_counts() -> list[Column]:
    """Aggregates over the chunks of a signal, each once: numbers only, so a signal may have any number of chunks.

    Count, bounds and a sum of hashes of the indexes tell whether the indexes are just those from 0 to the total, but
    for a chance of one in four billion. That takes no list of them, so a stream can keep it as state.
    """
    size, index = F.size("samples"), F.col("chunk_index")
    return [
        F.max("total_chunks").alias("total_chunks"),
        F.min("total_chunks").alias("least_total"),
        F.count("*").alias("received_chunks"),
        F.min(index).alias("first_index"),
        F.max(index).alias("last_index"),
        F.sum(_index_hash(index)).alias("index_hashes"),
        F.sum(size).alias("n"),
        F.max(size).alias("chunk_size"),
    ]


def _index_hash(index: Column) -> Column:
    return F.hash(index.cast("bigint")).cast("bigint")


def is_complete() -> Column:
    total = F.col("total_chunks").cast("bigint")
    counted = (
        (F.col("received_chunks") == total)
        & (F.col("least_total") == total)
        & (F.col("first_index") == 0)
        & (F.col("last_index") == total - 1)
    )
    expected = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), total - 1), F.lit(0).cast("bigint"), lambda a, i: a + _index_hash(i)
    )
    return F.when(counted, F.col("index_hashes") == expected).otherwise(False)


def chunk_completeness(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per signal: chunks expected and received, whether all are there, and how many samples they hold.

    A chunk index counts once, however often it came, and only below the total. Chunks that disagree about the total
    never make a signal complete.
    """
    size = F.size("samples")
    each = chunks.groupBy(*keys, "chunk_index").agg(
        F.max("total_chunks").alias("total_chunks"), F.min("total_chunks").alias("least_total"), F.max(size).alias("size")
    )
    inside = F.col("chunk_index").between(0, F.col("total_chunks") - 1)
    counted = each.groupBy(*keys).agg(
        F.max("total_chunks").alias("total_chunks"),
        F.min("least_total").alias("least_total"),
        F.count_if(inside).alias("received_chunks"),
        F.coalesce(F.sum(F.when(inside, F.col("size"))), F.lit(0)).alias("n"),
        F.max("size").alias("chunk_size"),
    )
    done = (F.col("received_chunks") == F.col("total_chunks")) & (F.col("least_total") == F.col("total_chunks"))
    return counted.withColumn("is_complete", done).drop("least_total")


def samples_of_chunks(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Back to one row per sample: keys, ``pos``, ``value``. The chunk knows where it starts, so nothing is sorted."""
    return chunks.select(*keys, "start_sample", F.posexplode("samples").alias("__i", "value")).select(
        *keys, (F.col("start_sample") + F.col("__i")).alias("pos"), "value"
    )


def reassemble(
    chunks: DataFrame, keys: Sequence[str], completeness: DataFrame | None = None, bucket: int = BUCKET
) -> DataFrame:
    """Numbered samples (keys, ``pos``, ``n``, ``value``) of the complete signals.

    Signals are never built as one array: that row would have no bound. Chunks meet their signal per bucket of
    chunk indexes, which spreads a signal with very many chunks over tasks. A message may leave out where its chunk
    starts; all chunks but the last are of one size, so the index tells.
    """
    keys = list(keys)
    if completeness is None:
        completeness = chunk_completeness(chunks, keys)
    complete = _buckets(completeness.filter("is_complete"), bucket).select(*keys, "n", "chunk_size", "__bucket")
    kept = chunks.select(*keys, "chunk_index", "start_sample", "samples").withColumn(
        "__bucket", msg.whole_division(F.col("chunk_index"), bucket)
    )
    start = F.coalesce(F.col("start_sample").cast("bigint"), F.col("chunk_index").cast("bigint") * F.col("chunk_size"))
    return (
        kept.join(complete, [*keys, "__bucket"])
        .select(*keys, "n", start.alias("__start"), F.posexplode("samples").alias("__i", "value"))
        .select(*keys, (F.col("__start") + F.col("__i")).alias("pos"), "n", "value")
    )


def _buckets(signals: DataFrame, bucket: int) -> DataFrame:
    """One row per signal and bucket of chunk indexes."""
    last = msg.whole_division(F.col("total_chunks") - 1, bucket)
    return signals.withColumn("__bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))


def incomplete_signals(chunks: DataFrame, keys: Sequence[str], bucket: int = BUCKET) -> DataFrame:
    """Signals that aren't complete, for the dead letters: keys, ``total_chunks``, ``received_chunks``, and in rows of one
    bucket of chunk indexes each the ``missing`` ones. Buckets without gaps have no row, but each signal has its first.

    Indexes are compared in buckets of bounded size instead of as one list per signal.
    """
    keys = list(keys)
    start, end = F.col("__bucket") * bucket, F.least((F.col("__bucket") + 1) * bucket, F.col("total_chunks"))
    incomplete = _buckets(chunk_completeness(chunks, keys).filter("NOT is_complete"), bucket)
    expected = incomplete.select(
        *keys, "total_chunks", "received_chunks", "__bucket", F.sequence(start, end - 1).alias("__expected")
    )
    received = (
        chunks.select(*keys, F.col("chunk_index").cast("bigint").alias("__index"))
        .withColumn("__bucket", msg.whole_division(F.col("__index"), bucket))
        .groupBy(*keys, "__bucket")
        .agg(F.collect_set("__index").alias("__received"))
    )
    gaps = F.array_except("__expected", F.coalesce("__received", F.array().cast("array<bigint>")))
    return (
        expected.join(received, [*keys, "__bucket"], "left")
        .select(*keys, "total_chunks", "received_chunks", "__bucket", gaps.alias("missing"))
        .filter((F.size("missing") > 0) | (F.col("__bucket") == 0))
        .drop("__bucket")
    )


def missing_chunks(chunks: DataFrame, keys: Sequence[str], bucket: int = BUCKET) -> DataFrame:
    """The chunk indexes that never arrived, one row each, for incomplete signals."""
    gaps = incomplete_signals(chunks, keys, bucket)
    return gaps.select(*keys, "total_chunks", F.explode("missing").alias("chunk_index"))
