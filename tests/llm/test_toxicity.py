"""Compression-distance scores: held-out accuracy, bounds and awkward rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from sigloom.llm import toxicity

BAD = ["grumblefink", "snarkwort", "vilebrand", "zotterkopf", "muckrake"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    parts = ["ta", "ri", "mo", "nel", "su", "pe", "lin", "dor", "vas", "ek"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(900):
        words, toxic = [word() for _ in range(rng.randint(20, 150))], int(i % 4 == 0)
        if toxic:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark, corpus, texts):
    docs = corpus[0] + [(5000 + k, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, corpus[0][3][1])]
    labels = corpus[1] + [(None, 1, 1), (5000, 1, None), (77777, 1, 1)]
    return (
        spark.createDataFrame([(i, t, "x", 1.0) for i, t in docs], "doc_id bigint, text string, toxic string, score double"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


@pytest.fixture(scope="module")
def scored(tables):
    return toxicity.score_documents(*tables).collect()


def test_held_out_accuracy(scored, corpus):
    truth = {i: y for i, _, y in corpus[1]}
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 100 and right / len(held) > 0.97


def test_rows_and_bounds(scored, tables):
    assert len(scored) == tables[0].count()
    for r in scored:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    assert len({r.score for r in scored if r.doc_id == 3}) == 1
    assert next(r for r in scored if r.doc_id == 5000).predicted == 0


def test_held_out_labels_change_nothing(tables, scored):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped) == toxicity.fit(docs, labels)


def test_labels_of_one_kind_or_none(tables):
    docs, labels = tables
    for known, expected in ((labels.limit(0), 0), (labels.filter("toxic = 0"), 0), (labels.filter("toxic = 1"), 1)):
        assert {r.predicted for r in toxicity.score_documents(docs, known).collect()} == {expected}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_keep_ordinary(tables, scored):
    kept = toxicity.keep_ordinary(*tables)
    assert kept.columns == tables[0].columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scored if not r.predicted)
