"""How two tokenizers cut the same bytes, with Arrow's own kernels inside the tasks.

A slice of documents is cut where a space, not the last character, follows a visible ASCII character: neither tokenizer ever joins bytes across
such a place. Each different piece is tokenized once by both, and the pieces' tokens are looked up. Token lists are flattened; lengths come from a table by id; cumulative sums
over the slice give byte ends, which are the same numbers for both tokenizers as their bytes are. A full outer hash join on
ends finds the places where both end and all others: between two neighbouring ends lies exactly one token of each side, a link. ``group_by`` makes the slice's different pairs and counts the documents that hold them.

Spark merges these counts per pair. A slice keeps its links as places in its own list of pairs, so that only lists of
different pairs are joined with the counts, never links; then every slice meets its list again and adds up. Pairs are
never broadcast. The highest count per id of A is: it has as many rows as A has ids.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written

#: Where the vocabularies lie on every executor.
TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a slice at most, unless one document is longer.
SLICE_BYTES = 2 << 20
#: Different pieces of text whose tokens a worker keeps, as Arrow arrays of some 50 bytes a piece.
REMEMBERED = 500_000
#: A pair of ids is first * PAIR + second.
PAIR = 1 << 20

_LINKED = (
    "slice long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, links array<int>, "
    "pairs array<long>, docs array<long>"
)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 stands for itself, the rest from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Tokenizers:
    """Both tokenizers and the bytes of their ids, loaded once in a worker."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.first, self.second = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
        self.first.encode_special_tokens = True
        letters = _byte_letters()
        special = {k for k, t in self.first.get_added_tokens_decoder().items() if t.special}
        entries = [self.first.id_to_token(k) or "" for k in range(self.first.get_vocab_size())]
        self.first_bytes = pa.array([e.encode() if k in special else bytes(letters[c] for c in e) for k, e in enumerate(entries)], pa.binary())
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.second_bytes = pa.array(
            [bytes([int(p[3:5], 16)]) if self.second.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)], pa.binary()
        )

        self.known = pa.array([], pa.binary())
        self.known_ids = tuple(pa.array([], pa.list_(pa.int32())) for _ in range(2))
        self.second_in_pieces = self._second_in_pieces(pieces)

    def _second_in_pieces(self, pieces: list[str]) -> bool:
        """No entry holds a space after something else, and spaces come back as they are."""
        probe = "  a  b c  "
        spelled = b"".join(self.second_bytes[k].as_py() for k in self.second.encode(probe))
        return all("▁" not in p.lstrip("▁") for p in pieces) and spelled == b" " + probe.encode()

    def encode(self, spaced: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both for texts with a space before them. The first REMEMBERED pieces of a worker aren't tokenized again."""
        pieces, per_text = _pieces(spaced)
        coded = pieces.dictionary_encode()
        places = pc.index_in(coded.dictionary, value_set=self.known).fill_null(-1).to_numpy().copy()
        unknown = places < 0
        fresh = coded.dictionary.filter(pa.array(unknown))
        places[unknown] = len(self.known) + np.arange(len(fresh), dtype=places.dtype)
        texts = fresh.cast(pa.string()).to_pylist()
        # The second tokenizer puts the space before a text itself.
        ids = (
            _lists([e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]),
            _lists(self.second.encode([t[1:] for t in texts], num_threads=1) if self.second_in_pieces else [[]] * len(texts)),
        )
        told = [pa.concat_arrays([old, new]) for old, new in zip(self.known_ids, ids)]
        where = pa.array(places[coded.indices.to_numpy()])
        first, second = (_of_texts(lists, where, per_text) for lists in told)
        kept = min(len(self.known) + len(fresh), REMEMBERED)
        if kept > len(self.known):
            self.known = pa.concat_arrays([self.known, fresh])[:kept]
            self.known_ids = tuple(lists[:kept] for lists in told)
        if not self.second_in_pieces:
            second = _lists(self.second.encode([t[1:] for t in spaced.cast(pa.string()).to_pylist()], num_threads=1))
        return first, second


def _pieces(spaced: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts cut before each space that follows a visible ASCII character, and how many pieces each text has."""
    ends = np.cumsum(pc.binary_length(spaced).to_numpy().astype(np.int64))
    data = b"".join(spaced.to_pylist())
    octets = np.frombuffer(data, np.uint8)
    visible = (octets > 0x20) & (octets < 0x7F)
    first = np.zeros(len(octets), bool)
    first[1:] = (octets[1:] == 0x20) & visible[:-1]
    first[ends - 1] = False  # a last space stays with its word
    first[np.append(0, ends[:-1]) if len(ends) else ends] = True
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
    return pieces, np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(spaced))


def _of_texts(ids: pa.ListArray, pieces: pa.Array, per_text: np.ndarray) -> pa.ListArray:
    """The ids of whole texts from those of their pieces."""
    taken = ids.take(pieces)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends[np.concatenate([[0], np.cumsum(per_text)])], pa.int32()), taken.flatten())


def _lists(ids: list[list[int]]) -> pa.ListArray:
    flat = np.fromiter(chain.from_iterable(ids), np.int32)
    return pa.ListArray.from_arrays(_offsets(np.fromiter(map(len, ids), np.int64, count=len(ids))), pa.array(flat))


@cache
def _loaded(first: str, second: str) -> _Tokenizers:
    return _Tokenizers(first, second)


def _joined(ids: pa.ListArray, spelled: pa.Array) -> pa.Array:
    """The bytes of each document's tokens."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelled.take(ids.flatten())), b"")


def _tokens(ids: pa.ListArray, spelled: pa.Array) -> pa.Table:
    """``id, doc, end``: every token, the document it is in, and its byte end, counted through the whole slice."""
    flat = ids.flatten()
    ends = pc.cumulative_sum(pc.cast(pc.binary_length(spelled.take(flat)), pa.int64()))
    return pa.table({"id": flat, "doc": pc.cast(pc.list_parent_indices(ids), pa.int64()), "end": ends})


def _per_document(parents: pa.Array, n: int) -> pa.Array:
    return pa.array(np.bincount(parents.to_numpy(zero_copy_only=False), minlength=n), pa.int64())


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _group_texts(tokens: pa.Table, common: pa.Array) -> pa.Array:
    """The ids of each group, comma-joined."""
    ends = tokens["end"].combine_chunks().to_numpy()
    cuts = np.searchsorted(ends, common.to_numpy(), "right")
    digits = pc.cast(tokens["id"].combine_chunks(), pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(_offsets(np.diff(cuts, prepend=0)), digits), ",")


def _align(number: int, doc_ids: pa.Array, texts: pa.Array, both: _Tokenizers) -> Iterator[pa.RecordBatch]:
    n = len(texts)
    spaced = pc.binary_join_element_wise(pa.scalar(b" "), texts.cast(pa.binary()), b"")
    a, b = both.encode(spaced)
    fits = pc.and_(pc.equal(_joined(a, both.first_bytes), spaced), pc.equal(_joined(b, both.second_bytes), spaced))
    fits = pc.and_(fits, pc.greater(pc.binary_length(texts), 0))
    none = pa.scalar([], a.type)
    ta, tb = (_tokens(pc.if_else(fits, x, none), s) for x, s in ((a, both.first_bytes), (b, both.second_bytes)))

    links = ta.rename_columns(["a", "doc", "end"]).join(
        tb.rename_columns(["b", "doc", "end"]).drop(["doc"]), "end", join_type="full outer", use_threads=False
    )
    links = links.sort_by("end").combine_chunks()
    groups = links.filter(pc.and_(pc.is_valid(links["a"]), pc.is_valid(links["b"])))
    per_group = pc.binary_join_element_wise(*(_group_texts(t, groups["end"].combine_chunks()) for t in (ta, tb)), "|")
    n_groups = _per_document(groups["doc"].combine_chunks(), n)
    texts_of = pc.binary_join(pa.ListArray.from_arrays(_offsets(n_groups.to_numpy()), per_group), ";")

    filled = {c: pc.fill_null_backward(links[c]) for c in ("a", "b", "doc")}
    pair = pc.add(pc.multiply(pc.cast(filled["a"], pa.int64()), PAIR), pc.cast(filled["b"], pa.int64())).combine_chunks()
    pair = pa.concat_arrays(pair.chunks) if isinstance(pair, pa.ChunkedArray) else pair
    doc = filled["doc"].combine_chunks()
    coded = pair.dictionary_encode()
    n_links = _per_document(doc, n)
    held = pa.table({"doc": doc, "k": coded.indices}).group_by(["doc", "k"], use_threads=False).aggregate([])
    counts = held.group_by("k", use_threads=False).aggregate([([], "count_all")]).sort_by("k")

    hashes = pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in texts_of.cast(pa.binary()).to_pylist()], pa.string())
    empty = pa.nulls(n, pa.list_(pa.int64()))
    names = ["slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "pairs", "docs"]
    kept = pa.ListArray.from_arrays(_offsets(n_links.to_numpy()), coded.indices)
    per = [_per_document(t["doc"].combine_chunks(), n) for t in (ta, tb)]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number), pa.int64()), doc_ids, *per, n_groups, n_links, hashes, kept, empty, empty], names=names)
    # The slice's list of pairs is one more row.
    lists = [pa.array([x.to_numpy(zero_copy_only=False)], pa.list_(pa.int64())) for x in (coded.dictionary, counts["count_all"].combine_chunks())]
    blank = [pa.nulls(1, t) for t in (doc_ids.type, *[pa.int64()] * 4, pa.string(), kept.type)]
    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *blank, *lists], names=names)


def aligned(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """Stored rows of two kinds: of documents, with ``n_a, n_b, n_groups, n_links, groups`` (sha256) and ``links`` (places
    in the list of their slice), and one per slice with its different ``pairs`` and the ``docs`` that hold each."""
    first, second = str(Path(folder, FIRST)), str(Path(folder, SECOND))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = _loaded(first, second), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").fill_null("")
            ends, at = np.cumsum(np.concatenate([[0], pc.binary_length(texts).to_numpy()])), 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
                yield from _align(number, batch.column("doc_id")[at:to], texts[at:to], both)
                number, at = number + 1, to
        # What slices took goes back now, not when this worker happens to end: later stages need it.
        pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(slices, _LINKED.format(id=kind)), "aligned")


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n, best``: how many documents hold a pair linked, and whether no pair of the same A id has more."""
    lists = found.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = written(lists.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n")), "pairs")
    counts = counts.withColumn("a", F.shiftright("pair", PAIR.bit_length() - 1))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    # As many rows as the first tokenizer has ids.
    return counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. Null and empty texts, and those whose tokens don't spell
    out a space and the text, have no tokens: zeros and ''. Rows count as documents: repeated ids, null ids and repeated
    rows each hold their pairs once more. Very long texts are slices of their own. No rows give none.
    """
    found = aligned(docs, folder)
    pairs = found.filter("pairs IS NOT NULL").select("slice", F.posexplode("pairs").alias("place", "pair"))
    told = written(pairs.join(pair_counts(found), "pair").select("slice", "place", "n", "best"), "told")

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        links = left["links"].combine_chunks()
        order = np.argsort(right["place"].to_numpy())
        flat = links.flatten().to_numpy()
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(links).to_numpy(zero_copy_only=False))]).astype(np.int64)

        def summed(values: np.ndarray) -> pa.Array:
            running = np.concatenate([[0], np.cumsum(values[order][flat])]) if len(flat) else np.zeros(1, np.int64)
            return pa.array(np.diff(running[cuts]), pa.int64())

        sums = [summed(right["best"].to_numpy().astype(np.int64)), summed(right["n"].to_numpy())]
        columns = [left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*columns, *sums, left["groups"]], names=[c.split(" ")[0] for c in out.split(", ")])

    texts = found.filter("pairs IS NULL").select("slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links")
    return texts.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(add_up, out)
