"""One query per operator, over whole tables, and SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import (
    centroids,
    chat_perspectives,
    decontamination,
    license_notices,
    merkle,
    mixing,
    personal_data,
    secret_ledger,
    simhash,
    spans,
    suffix_repeats,
    token_alignment,
    toxicity,
    url_filter,
)
from sigloom.shared_storage import written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def benchmark_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents: see ``decontamination.overlaps``."""
    return decontamination.overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score and prediction of every document: see ``toxicity.score_documents``."""
    return toxicity.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, each document a path of one version: see ``secret_ledger.scan_history``."""
    docs = _table(spark, folder, "documents")
    history = docs.select(F.col("doc_id").alias("path"), F.lit(0).alias("revision"), F.col("text").alias("content"))
    found = secret_ledger.scan_history(history)
    return found.select(
        F.col("path").alias("doc_id"),
        *[spans.of_kind(F.col("spans"), r.name).alias(f"n_{r.name}") for r in secret_ledger.BASE_RULES],
        spans.base_digest(F.col("spans")).alias("base_sha256"),
        spans.listed(F.col("spans")).alias("spans"),
    )


def license_notices_found(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in every document: see ``license_notices.notices``. The score is the best likeness, 0 without any."""
    found = _table(spark, folder, "documents").select("doc_id", license_notices.notices(F.col("text")).alias("n"))
    found = written(found.select("doc_id", "n.n_words", "n.found"), "notices")
    base = F.filter("found", lambda x: x["base"])

    def labels(rows):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda x: x["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first_word"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first_word"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["likeness"])), F.lit(0.0)).alias("score"),
    )


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document: see ``mixing.mix``."""
    return mixing.mix(_table(spark, folder, "documents"))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of every document: see ``simhash.near_duplicates``."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def personal_data_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: see ``personal_data.personal_data``."""
    found = _table(spark, folder, "documents").select("doc_id", personal_data.personal_data(F.col("text")).alias("found"))
    found = written(found, "spans")
    return found.select(
        "doc_id",
        *[spans.of_kind(F.col("found"), kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        spans.base_digest(F.col("found")).alias("base_sha256"),
        spans.listed(F.col("found")).alias("spans"),
    )


def tree_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Root of every document and of its edited text, and what their trees share: see ``merkle``."""
    rows = merkle.with_next(_table(spark, folder, "documents"))
    rows = rows.withColumn("edited", merkle.edited(F.col("text"), F.col("next_text")))
    return merkle.compared(rows).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def chat_renderings(spark: SparkSession, folder: str) -> DataFrame:
    """Every dialogue from every participant's side: see ``chat_perspectives.perspectives``."""
    sides = chat_perspectives.perspectives(_table(spark, folder, "conversations"))
    spans_text = F.array_join(F.transform("learn", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return sides.withColumn("learn", spans_text)


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page: see ``url_filter.judge``."""
    return url_filter.judge(_table(spark, folder, "pages"))


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """What repeated passages leave of every document: see ``suffix_repeats.removed_bytes``."""
    return suffix_repeats.removed_bytes(_table(spark, folder, "documents"))


def tokenizer_links(spark: SparkSession, folder: str) -> DataFrame:
    """Where two tokenizers agree in every document: see ``token_alignment.alignment``."""
    return token_alignment.alignment(_table(spark, folder, "documents"))


def vector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every vector: see ``centroids.assignments``."""
    return centroids.assignments(_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_spaced_seed_decontamination": benchmark_overlaps,
    "op2_secret_ledger": secret_spans,
    "op3_compression_toxicity": toxicity_scores,
    "op4_hash_threshold_mix": source_mix,
    "op5_license_notices": license_notices_found,
    "op6_merkle_fingerprints": tree_fingerprints,
    "op7_simhash_near_duplicates": near_duplicates,
    "op8_personal_data": personal_data_spans,
    "op9_perspective_rotation": chat_renderings,
    "op10_url_filter": url_verdicts,
    "op11_suffix_repeats": repeated_passages,
    "op12_token_alignment": tokenizer_links,
    "op13_centroid_clusters": vector_clusters,
}
