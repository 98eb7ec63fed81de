"""Passages of ``length`` bytes that stand anywhere else, by suffix buckets and the ranks of a difference cover.

Suffixes count by their first ``length`` bytes: those that agree there are ties. Ordering all of them at once would move
some ten bytes for each byte of text. A difference cover keeps nearly all of them out:

* COVER is a set of residues modulo PERIOD such that any two positions have one distance below PERIOD at which both stand
  on the cover. Positions on the cover are ranked first, by the ``length - PERIOD + 1`` bytes from there: has another
  position of the cover the same rank, or none? Two suffixes that tie have a common cover position in their first PERIOD
  bytes, and these tie as well. So a suffix none of whose cover positions has a rank in common with another is settled.
* The rest goes to buckets by the first bits of a hash of its first ``length`` bytes (any order will do, only ties
  matter), and one bucket at a time is sorted. A bucket holds some BUCKET_BYTES of text, whatever the size of the input.

Documents are packed into compressed blocks once, so that every pass sees the same bytes in the same order. A block sends
each bucket one row: different keys, packed, with a mark on those the block itself holds twice or more. So a passage that
a third of all documents hold is one key per block. Back comes one bit per key, in the same order; the block makes its
keys again and reads the bits. Equal means equal in 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written

LENGTH = 200
#: Residues of which any two positions share one at some common distance below PERIOD.
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes of text in a block at most, unless one document is longer; bytes of text per bucket, and buckets at least.
BLOCK_BYTES, BUCKET_BYTES, LEAST_BUCKET_BITS = 4 << 20, 8 << 20, 10
#: Bytes of a key that travel: fewer for ranks, where a false tie only sends a suffix on to its bucket.
RANK_BYTES, SUFFIX_BYTES = 5, 7

_BLOCK = "block long, n_bytes long, lengths array<long>, packed binary"
_KEYS = "bucket long, block long, steps binary, rest binary, twice binary"
_BITS = "bucket long, block long, bits binary"


def pack(docs: DataFrame) -> DataFrame:
    """Documents in the order of the scan, in blocks of BLOCK_BYTES: ``block, doc_ids, n_bytes, lengths, packed``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, zstd = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            ids, ends = batch.column("doc_id"), np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data, first = memoryview(texts.buffers()[2] or b""), 0
            while first < len(texts):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_BYTES, "right")) - 1)
                raw = bytes(data[ends[first] : ends[last]])
                row = {
                    "block": pa.array([number], pa.int64()),
                    "n_bytes": pa.array([len(raw)], pa.int64()),
                    "lengths": pa.array([np.diff(ends[first : last + 1])], pa.list_(pa.int64())),
                    "packed": pa.array([zstd.compress(raw)], pa.binary()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), ids[first:last]),
                }
                yield pa.RecordBatch.from_pydict(row)
                number, first = number + 1, last

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(blocks, f"{_BLOCK}, doc_ids array<{kind}>")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, well spread over 64 bits; the order counts."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += b
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position; the last positions see zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy()


def _wide(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` bytes from every position, a power of two: each from its halves."""
    for half in (8 << k for k in range(width.bit_length() - 4)):
        words = _mixed(words[:-half], words[half:])
    return words


class _Block:
    """The bytes of a block, where its documents lie, and its suffixes."""

    def __init__(self, packed: bytes, n_bytes: int, lengths: np.ndarray, length: int):
        self.length = length
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed, n_bytes) if n_bytes else b"", np.uint8)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.words, self.wide = _words(self.data), {}

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the ``length`` bytes from the positions ``at``: of the first and the last of them, which overlap."""
        if not len(at):
            return np.zeros(0, np.uint64)
        width = 1 << (length.bit_length() - 1)
        if width not in self.wide:
            self.wide[width] = _wide(self.words, width)
        return _mixed(self.wide[width][at], self.wide[width][at + length - width])

    def cover(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions on the cover in documents that have room for a suffix, and the starts of their documents."""
        reach, at, begin = self.length - PERIOD + 1, [], []
        for s, e in zip(self.starts.tolist(), self.ends.tolist()):
            if e - s >= self.length:
                grid = np.arange(s, e - reach + 1, PERIOD)[:, None] + np.array(COVER)
                on = grid[grid <= e - reach]
                at.append(on)
                begin.append(np.full(len(on), s))
        none = np.zeros(0, np.int64)
        return (np.concatenate(at), np.concatenate(begin)) if at else (none, none)

    def ranks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different keys of the cover in order, which key each position has, and how often each occurs."""
        return np.unique(self.hashes(self.cover()[0], self.length - PERIOD + 1), return_inverse=True, return_counts=True)

    def open_suffixes(self, tied: np.ndarray) -> np.ndarray:
        """Suffixes with a cover position in their first PERIOD bytes whose key, by ``tied``, others have too."""
        at, begin = self.cover()
        at, begin = at[tied], begin[tied]
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, np.maximum(begin, at - PERIOD + 1), 1)
        np.add.at(steps, at + 1, -1)
        found = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        return found[found + self.length <= self.ends[np.searchsorted(self.ends, found, "right")]] if len(found) else found

    def suffixes(self, tied: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        at = self.open_suffixes(tied)
        return at, np.unique(self.hashes(at, self.length), return_inverse=True, return_counts=True)


def _rows(block: int, keys: np.ndarray, counts: np.ndarray, bits: int, width: int) -> pa.RecordBatch:
    """Keys in order, cut at the buckets; of each key the ``width`` bytes after the bucket's bits. Of the first of these
    bytes, which are in order, the steps go compressed."""
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
    ends = np.append(cuts[1:], len(keys))
    octets = (keys << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)
    first, rest, zstd = np.ascontiguousarray(octets[:, 0]), np.ascontiguousarray(octets[:, 1:width]), zstandard.ZstdCompressor(level=1)
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(buckets[cuts], pa.int64()),
            "block": pa.array(np.full(len(cuts), block), pa.int64()),
            "steps": pa.array([zstd.compress(np.diff(first[a:b], prepend=np.uint8(0)).tobytes()) for a, b in zip(cuts, ends)], pa.binary()),
            "rest": pa.array([rest[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "twice": pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def _answers(parts: list[dict], keys: np.ndarray, bits: int) -> np.ndarray:
    """The bit of every key, in the order of ``keys``; ``parts`` are the rows of all buckets."""
    sizes = np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) if len(keys) else np.zeros(1, np.int64)
    by_bucket = sorted(((p["bucket"], p["bits"]) for p in parts))
    out = [np.unpackbits(np.frombuffer(b, np.uint8), count=int(sizes[k])).astype(bool) for k, b in by_bucket]
    return np.concatenate(out) if out else np.zeros(0, bool)


def _each(table: DataFrame, schema: str, work: Callable[[dict], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                yield from work({n: batch.column(n)[k].as_py() for n in batch.schema.names if n != "doc_ids"} | {"ids": batch.column("doc_ids")[k].values})

    return table.mapInArrow(run, schema)


def _ties(rows: DataFrame, width: int, label: str) -> DataFrame:
    """One bucket at a time: sorts its keys and says of each whether it ties. ``block, parts``, a row per block."""

    def sort_bucket(table: pa.Table) -> pa.Table:
        zstd = zstandard.ZstdDecompressor()
        steps = [np.frombuffer(zstd.decompress(x), np.uint8) for x in table.column("steps").to_pylist()]
        sizes = [len(x) for x in steps]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, 0] = np.concatenate([np.cumsum(x, dtype=np.uint8) for x in steps])
        wide[:, 1:width] = np.frombuffer(b"".join(table.column("rest").to_pylist()), np.uint8).reshape(-1, width - 1)
        keys = wide.view(">u8").ravel().astype(np.uint64)
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(table.column("twice").to_pylist(), sizes)]
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        run = np.concatenate([[0], np.cumsum(~same)])
        many = np.bincount(run, 1 + np.concatenate(twice)[order]) > 1
        tied = np.zeros(len(keys), bool)
        tied[order] = many[run]
        cuts = np.cumsum(sizes)[:-1]
        bits = pa.array([np.packbits(x).tobytes() for x in np.split(tied, cuts)], pa.binary())
        return table.select(["bucket", "block"]).append_column("bits", bits)

    answered = written(rows.groupBy("bucket").applyInArrow(sort_bucket, _BITS), label)
    return answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("parts"))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, removed, kept``: a row per row of ``docs`` (``doc_id, text``; other columns are ignored).

    ``removed`` are the maximal runs (``start, end``, bytes, end exclusive) of bytes covered by a ``length``-byte string
    that also starts anywhere else in the documents, overlaps in the same text included; ``kept`` is the rest of the
    UTF-8 bytes. Strings don't cross documents. Rows that repeat a text lose all bytes if it has ``length`` of them. Null
    texts are empty; null and repeated ids are rows like others; no rows give none. Very long texts are blocks of their
    own. ``length`` must exceed PERIOD + 7.
    """
    if length < PERIOD + 7:
        raise ValueError(f"length must be {PERIOD + 7} or more")
    blocks = written(pack(docs), "blocks")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(LEAST_BUCKET_BITS, (total // BUCKET_BYTES).bit_length())

    def opened(row: dict) -> _Block:
        return _Block(row["packed"], row["n_bytes"], np.array(row["lengths"], np.int64), length)

    def rank_keys(row: dict) -> Iterator[pa.RecordBatch]:
        keys, _, counts = opened(row).ranks()
        yield _rows(row["block"], keys, counts, bits, RANK_BYTES)

    def tied_positions(block: _Block, row: dict) -> np.ndarray:
        keys, which, _ = block.ranks()
        return _answers(row["ranks"], keys, bits)[which] if len(keys) else np.zeros(0, bool)

    def suffix_keys(row: dict) -> Iterator[pa.RecordBatch]:
        block = opened(row)
        _, (keys, _, counts) = block.suffixes(tied_positions(block, row))
        yield _rows(row["block"], keys, counts, bits, SUFFIX_BYTES)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        block = opened(row)
        covered = np.zeros(len(block.data), bool)
        if row["suffixes"]:
            at, (keys, which, _) = block.suffixes(tied_positions(block, row))
            at = at[_answers(row["suffixes"], keys, bits)[which]]
            steps = np.zeros(len(block.data) + 1, np.int32)
            np.add.at(steps, at, 1)
            np.add.at(steps, at + length, -1)
            covered = np.cumsum(steps[:-1]) > 0
        runs, kept = [], []
        for s, e in zip(block.starts.tolist(), block.ends.tolist()):
            own = covered[s:e]
            if own.any():
                edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                runs.append([{"start": a, "end": b} for a, b in edges.tolist()])
                kept.append(block.data[s:e][~own].tobytes())
            else:
                runs.append([])
                kept.append(block.data[s:e].tobytes())
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [row["ids"], pa.array(row["lengths"], pa.int64()), pa.array(runs, spans), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "removed", "kept"],
        )

    ranks = _ties(_each(blocks, _KEYS, rank_keys), RANK_BYTES, "ranks").withColumnRenamed("parts", "ranks")
    ranked = blocks.join(ranks, "block", "left")
    suffixes = _ties(_each(ranked.filter("ranks IS NOT NULL"), _KEYS, suffix_keys), SUFFIX_BYTES, "ties")
    both = ranked.join(suffixes.withColumnRenamed("parts", "suffixes"), "block", "left")
    return _each(both, out, cut)


def removed_bytes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    found = repeats(docs)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
