"""Toxic documents by compression distance: which of two zstandard dictionaries shortens a window more.

A window is one word, written ``REPEATS`` times so that the fixed cost of a compressed frame doesn't swamp it. Its
ordinary length is taken with a dictionary trained on words of ordinary documents, its toxic length with that
dictionary behind one of words from toxic documents. The two share their ordinary part, so that ordinary words come out
at equal lengths and a difference means toxic matter. The toxic dictionary is trained on words that hold byte runs
found in many more different contexts in toxic documents than in ordinary ones; copies of a document are one context.

A document's score is a logistic curve over how many of its windows pass each calibrated difference, fitted on
labelled rows. The fit uses a bounded sample of these (``FIT_DOCS`` of each label, smallest hash first) with their whole
texts, and the same features as scoring. Runs, contexts, words and features are counted by the executors; the driver
gets ``FIT_RUNS`` runs, ``FIT_WORDS`` words of each label and a row of numbers per sampled document at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written

#: Labelled documents of each label that the fit may use at most.
FIT_DOCS = 2_000
#: Telling runs and words of one label that a model is made of at most: the most frequent ones.
FIT_RUNS, FIT_WORDS = 20_000, 20_000
#: Rows with this remainder of crc32(doc_id) by HELD_OUT_OF are never learnt from.
HELD_OUT_OF = 5
REPEATS = 4
LEVEL = 13
ORDINARY_BYTES = 8_192
TOXIC_BYTES = 8_192
#: Bytes of a run, of the context on each side that tells occurrences apart, and how much more often toxic documents must hold it.
RUN, CONTEXT, RATIO = 4, 4, 8
#: Differences in bytes that are counted.
DIFFERENCES = (2, 3, 5)
#: Counts above this add nothing.
MOST = 8
#: Longer words are cut into windows of this many bytes.
WINDOW_BYTES = 64
#: Different windows whose lengths a task remembers.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Model:
    """What a scoring task needs: two dictionaries and the curve."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def held_out(doc_id: Column) -> Column:
    """A null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


def _words(text: str | None) -> list[bytes]:
    out = []
    for word in (text or "").lower().encode("utf-8", "replace").split():
        if len(word) <= WINDOW_BYTES:
            out.append(word)
        else:
            out += [word[k : k + WINDOW_BYTES] for k in range(0, len(word), WINDOW_BYTES)]
    return out


def _compressor(dictionary: bytes):
    kwargs = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if len(dictionary) >= 8:
        raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        kwargs["dict_data"] = raw
    return zstandard.ZstdCompressor(**kwargs)


class _Lengths:
    """Length differences of windows; the latest are remembered up to REMEMBERED."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.both, self.seen = _compressor(ordinary), _compressor(toxic + ordinary), {}

    def difference(self, word: bytes) -> int:
        known = self.seen.get(word)
        if known is None:
            window = (b" " + word) * REPEATS + b" "
            known = len(self.plain.compress(window)) - len(self.both.compress(window))
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = known
        return known

    def features(self, text: str | None) -> list[float]:
        """Windows at each difference or above, capped at MOST, one more for each doubling left out."""
        words, counts = _words(text), [0] * len(DIFFERENCES)
        for word, times in Counter(words).items():
            gain = self.difference(word)
            for k, least in enumerate(DIFFERENCES):
                if gain >= least:
                    counts[k] += times
        return [1.0, *(float(min(c, MOST)) for c in counts), math.log1p(len(words)) / 10]


def _trained(samples: list[bytes], size: int, seed: int) -> bytes:
    """The content of a zstandard dictionary; samples that fit as they are need no training."""
    order = np.random.default_rng(seed).permutation(len(samples))
    samples = [samples[k] for k in order]
    if sum(map(len, samples)) <= size:
        return b"".join(samples)
    try:
        # The trainer puts tables before the content; the content is the end.
        return zstandard.train_dictionary(size + 1_024, samples, k=16, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:  # too few samples for the trainer
        return b"".join(samples)[-size:]


def _contexts(text: str | None) -> np.ndarray:
    """Different (run, context) of a text: RUN bytes above, a hash of them and CONTEXT bytes on both sides below."""
    data = b" " * CONTEXT + b" ".join([b"", *_words(text), b""]) + b" " * CONTEXT
    n = len(data) - 2 * CONTEXT - RUN + 1
    around = np.zeros(max(0, n), np.uint64)
    for k in range(2 * CONTEXT + RUN):
        around = (around + np.frombuffer(data, np.uint8, max(0, n), k)) * np.uint64(0x9E3779B97F4A7C15)
    run = np.zeros(len(around), np.uint64)
    for k in range(RUN):
        run = (run << np.uint64(8)) | np.frombuffer(data, np.uint8, len(run), CONTEXT + k)
    return np.unique((run << np.uint64(32)) | (around >> np.uint64(32))).view(np.int64)


def _telling_runs(sample: DataFrame) -> set[bytes]:
    """Byte runs in many more contexts of toxic documents than of ordinary ones."""

    @F.arrow_udf("array<long>")
    def contexts(texts: pa.Array) -> pa.Array:
        return pa.array([_contexts(t.as_py()) for t in texts], type=pa.list_(pa.int64()))

    found = sample.select("toxic", F.explode(contexts("text")).alias("at"))
    found = found.groupBy("at").agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("o"))
    counts = written(found.groupBy(F.shiftrightunsigned("at", 32).alias("run")).agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "runs")
    docs, total = sample.agg(F.sum("toxic")).first()[0] or 0, counts.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    scale = (total.o or 0) / max(1, total.t or 0)
    telling = counts.filter((F.col("t") >= max(3, docs // 100)) & (F.col("t") * scale >= RATIO * (F.col("o") + 1)))
    return {r.run.to_bytes(RUN, "big") for r in telling.orderBy(F.desc("t"), "run").limit(FIT_RUNS).collect()}


def _frequent_words(sample: DataFrame, telling: set[bytes] | None = None) -> list[tuple[bytes, int]]:
    """Words by how many documents hold them, the most frequent first; with ``telling``, those that hold such a run."""

    @F.arrow_udf("array<binary>")
    def different(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            words = dict.fromkeys(_words(text.as_py()))
            if telling is not None:
                words = [w for w in words if any((b" " + w + b" ")[k : k + RUN] in telling for k in range(len(w) - RUN + 3))]
            out.append(list(words))
        return pa.array(out, type=pa.list_(pa.binary()))

    counts = sample.select(F.explode(different("text")).alias("word")).groupBy("word").count()
    return [(bytes(r.word), r["count"]) for r in counts.orderBy(F.desc("count"), "word").limit(FIT_WORDS).collect()]


def _curve(rows: list[list[float]], labels: list[int]) -> tuple[float, ...]:
    """Logistic regression by Newton's steps, a little ridge, and both labels weighing as they come."""
    if not rows or len(set(labels)) < 2:
        share = 0.25 if not labels else (0.75 if labels[0] else 0.25)
        return (math.log(share / (1 - share)), *(0.0 for _ in DIFFERENCES), 0.0)
    x, y = np.array(rows), np.array(labels, dtype=float)
    ridge, w = np.diag([1e-6] + [0.05] * (x.shape[1] - 1)), np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled rows that aren't held out; see the bounds above.

    ``labels`` needs ``doc_id, toxic``; null labels are left out. A document labelled both ways counts as toxic. With no
    rows of one label every document gets the same score, under one half unless all known rows are toxic.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    picked = known.filter("toxic = 1").orderBy("h", "doc_id").limit(FIT_DOCS)
    picked = picked.unionByName(known.filter("toxic = 0").orderBy("h", "doc_id").limit(FIT_DOCS))
    picked = F.broadcast(picked.select("doc_id", "toxic"))  # 2 x FIT_DOCS rows at most

    # Rows that repeat an id count once, by their smallest text. 2 x FIT_DOCS rows at most.
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id")
    sample = sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    sample = written(sample.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"), "text"), "labelled")
    telling = _telling_runs(sample)
    plain = [b" " + w + b" " for w, n in sorted(_frequent_words(sample.filter("toxic = 0"))) for _ in range(min(n, 20))]
    bad = [w for w, n in _frequent_words(sample.filter("toxic = 1"), telling) if n >= 2] if telling else []
    model = Model(_trained(plain, ORDINARY_BYTES, 1), _kept([(b" " + w) * REPEATS + b" " for w in bad]), ())
    rows = sample.select("doc_id", "toxic", features(F.col("text"), model).alias("x")).orderBy("doc_id").select("toxic", "x").collect()
    return Model(model.ordinary, model.toxic, _curve([list(r.x) for r in rows], [r.toxic for r in rows]))


def _kept(windows: list[bytes]) -> bytes:
    """The toxic dictionary: trained, if the windows don't fit as they are. The most frequent come last, nearest."""
    if sum(map(len, windows)) > TOXIC_BYTES:
        return _trained(windows, TOXIC_BYTES, 2)
    return b"".join(reversed(windows))


def features(text: Column, model: Model) -> Column:
    """What ``_Lengths.features`` counts in a text."""

    @F.arrow_udf("array<double>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = _Lengths(model.ordinary, model.toxic)
        for texts in batches:
            yield pa.array([lengths.features(t.as_py()) for t in texts], type=pa.list_(pa.float64()))

    return counted(text)


def score(text: Column, model: Model) -> Column:
    """0 to 1; null and empty texts score as documents without windows."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths, weights = _Lengths(model.ordinary, model.toxic), np.array(model.weights)
        for texts in batches:
            z = np.array([float(weights @ lengths.features(t.as_py())) for t in texts])
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), type=pa.float64())

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``. Only ``text`` goes into a score.

    Repeated rows score alike, very long texts whole. A null doc_id keeps its row; an empty table gives none. Other
    columns are ignored.
    """
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic, each row by its own text.

    Null and empty texts and null ids stay unless the model takes such texts for toxic; repeated rows share their fate.
    Very long texts are scored whole. Any other columns go through, whatever their names. An empty table stays empty.
    """
    return docs.filter(score(F.col("text"), fit(docs, labels)) < 0.5)
