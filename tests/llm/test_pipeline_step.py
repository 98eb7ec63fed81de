"""The near-duplicate step of the pipeline goes by the fingerprints of its operator."""

import random

import corpus_pipeline
from sigloom.llm import simhash


def test_step_keeps_one_of_each_fingerprint_class(spark):
    rng = random.Random(5)
    rows = []
    for k in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows.append((3 * k, " ".join(words)))
        rows.append((3 * k + 1, " ".join(words).upper()))
        words[30] = "other"
        rows.append((3 * k + 2, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = sorted({r.component_id for r in simhash.near_duplicates(docs).collect()})
    kept = sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect())
    assert kept == expected and 30 < len(kept) <= 60


def test_step_decides_by_row(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (2, "A b  c d"), (2, "quite another one here"), (9, None), (8, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = simhash.keep_one_fingerprint(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "A b  c d"), (2, "quite another one here"), (8, "")]
    assert simhash.keep_one_fingerprint(docs.limit(0)).count() == 0
