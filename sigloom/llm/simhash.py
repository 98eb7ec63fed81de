"""Near-duplicate documents by SimHash fingerprints and a table of distances to reference fingerprints.

Fingerprints are made in Arrow batches. All that follows works on distinct fingerprints, so copies cost nothing, and
stays in Spark's own operators:

* Every fingerprint gets its Hamming distances to many reference fingerprints. By the triangle inequality two
  fingerprints within ``LINK_BITS`` differ by no more than that in any coordinate of this table.
* Pairs come from fingerprints that agree outside two of four blocks of bits, as any pair within two bits does. Those of
  a pair whose coordinates differ too much are discarded, the rest is verified by the exact distance.
* Where more than ``GROUP_LIMIT`` fingerprints agree so, the open bits are split into four blocks again, up to three
  times; then at most 256 fingerprints can agree. So no group is unbounded and no link is lost.

``keep_one_fingerprint`` keeps one document of each class; it is the step of the pipeline. ``similar_documents`` and
``keep_one`` are for documents that are similar in their words, which may be many bits apart: they work on the shingles
themselves, see there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.components import components
from sigloom.operators.joins import broadcast_if_small
from sigloom.shared_storage import delete_path, fresh_path, stored, written, written_apart

#: Fingerprints link at this many differing bits or fewer.
LINK_BITS = 2
SHINGLE_WORDS = 3
SEED = 42
#: Groups up to this size are compared at once; larger ones are split by further bits.
GROUP_LIMIT = 64
#: Reference fingerprints of the distance table.
REFERENCES = 12
#: For similar documents: words of the shingles that are compared, and their share (Jaccard).
SIMILAR_WORDS, SIMILARITY = 5, 0.8
#: Bits of a set's sketch, a power of two.
SKETCH_BITS = 512
#: One document in SAMPLE is searched for shingles that COMMON of them hold; the commonest are known to every task.
SAMPLE, COMMON, MOST_COMMON = 16, 8, 200_000

#: Parts in which pairs are verified one after the other, so that less is on disk at a time.
PARTS = 4

#: Blocks of a document's shingles whose bits are counted at a time.
COUNT_ROWS = 65_536


def _fingerprint(text: str | None, words: int) -> int:
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)], dtype=np.uint64)
    else:
        joined = b" ".join(tokens)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), COUNT_ROWS):
        octets = hashes[k : k + COUNT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """64-bit SimHash of shingles of ``words`` words, as a long.

    Words are runs without ASCII white space, A-Z lower-cased; each shingle, repeats included, votes with its XXH64.
    Fewer words than a shingle: the whole sequence is one. No words or null: zero.
    """

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t.as_py(), words) for t in texts], type=pa.int64())

    return simhash(text)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _references() -> list[int]:
    """Spread over the space: hashes of the numbers from 0."""
    return [_signed(xxhash.xxh64_intdigest(str(k), SEED)) for k in range(REFERENCES)]


def _splits(blocks: tuple[int, ...], width: int) -> list[tuple[tuple[int, ...], int]]:
    """The open blocks halved, and two of the four left open: (starts, width) of each choice."""
    parts = [b + d for b in blocks for d in (0, width // 2)]
    return [(pair, width // 2) for pair in combinations(parts, 2)]


def _mask(blocks: tuple[int, ...], width: int) -> int:
    return _signed(sum(((1 << width) - 1) << b for b in blocks))


def _levels() -> list[dict[int, list[int]]]:
    """By level: the masks of open bits that follow from each mask of the level before. The first follows from all bits."""
    first = [(pair, 16) for pair in combinations(range(0, 64, 16), 2)]
    out, now = [{-1: [_mask(*x) for x in first]}], first
    for _ in range(2):
        after = {_mask(*x): _splits(*x) for x in now}
        out.append({mask: [_mask(*x) for x in choices] for mask, choices in after.items()})
        now = list({_mask(*x): x for choices in after.values() for x in choices}.values())
    return out


def distance_table(prints: DataFrame) -> DataFrame:
    """Adds ``d0``, ``d1``, ...: the Hamming distances of ``fp`` to the reference fingerprints."""
    return prints.withColumns(
        {f"d{k}": F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("byte") for k, r in enumerate(_references())}
    )


def _close(left: str, right: str, bits: int = LINK_BITS) -> Column:
    """Coordinates differ by no more than ``bits`` at most; then the exact distance."""
    close = F.lit(True)
    for k in range(REFERENCES):
        close = close & (F.abs(F.col(f"{left}.d{k}") - F.col(f"{right}.d{k}")) <= bits)
    return close & (F.bit_count(F.col(f"{left}.fp").bitwiseXOR(F.col(f"{right}.fp"))) <= bits)


def linked(prints: DataFrame) -> DataFrame:
    """Pairs ``a, b`` (a < b) of distinct fingerprints ``fp`` within LINK_BITS. A pair can come more than once."""
    table = written(distance_table(prints.select("fp").distinct()), "distances")
    members = table.withColumn("open", F.lit(-1).cast("long"))
    pairs = None
    levels = _levels()
    for depth, choices in enumerate(levels):
        if len(choices) == 1:
            opened = F.array(*[F.lit(m) for m in choices[-1]])
        else:
            opened = F.create_map(*[x for k, v in choices.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])[F.col("open")]
        members = members.withColumn("open", F.explode(opened)).withColumn(
            "fixed", F.col("fp").bitwiseAND(F.bitwise_not(F.col("open")))
        )
        key = ["open", "fixed"]
        if depth + 1 < len(levels):
            large = written(members.groupBy(*key).count().filter(F.col("count") > GROUP_LIMIT).select(*key), "large")
            members, rest = members.join(large, key, "left_semi"), members.join(large, key, "left_anti")
            members, now = members.drop("fixed"), rest
        else:
            now = members
        left, right = now.alias("l"), now.alias("r")
        same = (F.col("l.open") == F.col("r.open")) & (F.col("l.fixed") == F.col("r.fixed"))
        found = left.join(right, same & (F.col("l.fp") < F.col("r.fp")) & _close("l", "r")).select(
            F.col("l.fp").alias("a"), F.col("r.fp").alias("b")
        )
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs


def _classes(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``prints`` (``doc_id, fp, ...``) as a table, and one row per fingerprint: ``fp, first`` (smallest doc_id), ``root``."""
    prints = written(prints, "fingerprints")
    roots = components(linked(prints)).select(F.col("node").alias("fp"), "root")
    named = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    return prints, written(named.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "classes")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. ``component_id`` is the smallest doc_id in the class.
    Equal fingerprints are always one class. A repeated doc_id gives a row each time; a null doc_id keeps its row and
    never names a class unless the class has no other. An empty table gives no rows.
    """
    prints, named = _classes(docs.select("doc_id", fingerprint(F.col("text"), words).alias("fp")))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return prints.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _shingle_set(text: str | None) -> np.ndarray:
    """Different hashes of the shingles of SIMILAR_WORDS words, in order; fewer words are one shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(tokens)
    if len(tokens) <= SIMILAR_WORDS:
        return np.array([xxhash.xxh64_intdigest(joined)], dtype=np.uint64).view(np.int64)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = [0, *(ends[: len(tokens) - SIMILAR_WORDS] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = (digest(joined[s:e]) for s, e in zip(starts, ends[SIMILAR_WORDS - 1 :].tolist()))
    return np.unique(np.fromiter(hashes, dtype=np.uint64, count=len(starts)).view(np.int64))


def _shingles(text: str | None) -> list[int]:
    return _shingle_set(text).tolist()


def _least_shared(left: Column, right: Column) -> Column:
    """Shingles that sets of these sizes share at least if they are similar; the rest is slack for rounding."""
    return F.lit(SIMILARITY / (1 + SIMILARITY)) * (left + right) - 1e-6


def _prefix(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones before ``common`` ones: similar sets share one of these at least."""
    if len(common):
        place = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        known = common[place] == shingles
        often = shingles[known]
        shingles = np.concatenate([shingles[~known], often[np.argsort(ranks[place[known]])]])
    return shingles[: len(shingles) - int(np.ceil(SIMILARITY * len(shingles) - 1e-6)) + 1]


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """For each of SKETCH_BITS cells whether it holds an odd number of the shingles."""
    odd = (np.bincount(shingles & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def _shingle_sets(text: Column, common: np.ndarray, ranks: np.ndarray) -> Column:
    """``node`` (hash of the whole set), ``n`` (its size), ``sketch``, ``prefix``."""
    longs = pa.list_(pa.int64())
    kind = pa.struct([("node", pa.int64()), ("n", pa.int32()), ("sketch", longs), ("prefix", longs)])

    @F.arrow_udf("node long, n int, sketch array<long>, prefix array<long>")
    def sets(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            s = _shingle_set(t.as_py())
            node = np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64)
            rows.append({"node": int(node), "n": len(s), "sketch": _sketch(s), "prefix": _prefix(s, common, ranks)})
        return pa.array(rows, type=kind)

    return sets(text)


def _shingle_lists(text: str) -> Column:
    @F.arrow_udf("array<long>")
    def lists(texts: pa.Array) -> pa.Array:
        return pa.array([_shingle_set(t.as_py()) for t in texts], type=pa.list_(pa.int64()))

    return lists(text)


def _common(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents of a sample hold, in order, and their ranks by how many. Any answer gives the same
    pairs: it only decides in which order shingles stand."""
    some = known.filter(F.pmod("content", F.lit(SAMPLE)) == 0).dropDuplicates(["content"])
    counts = some.select(F.explode(_shingle_lists("text")).alias("shingle")).groupBy("shingle").count()
    often = counts.filter(F.col("count") >= COMMON).orderBy(F.desc("count"), "shingle").limit(MOST_COMMON)
    found = [r.shingle for r in often.select("shingle").collect()]
    common = np.array(found, dtype=np.int64)
    order = np.argsort(common)
    return common[order], -order


def _may_be_similar(left: str, right: str) -> Column:
    """Of rows ``n, at`` with the same shingle at places ``at``, the first that both sets have: no similar pair is lost."""
    ln, la, rn, ra = (F.col(f"{x}.{c}") for x in (left, right) for c in ("n", "at"))
    sizes = F.least(ln, rn) >= SIMILARITY * F.greatest(ln, rn) - 1e-6
    return sizes & (F.least(ln - la, rn - ra) >= _least_shared(ln, rn))


def _similar(pairs: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs ``a, b`` of nodes whose shingles overlap by SIMILARITY or more."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sketches = sets.select("node", "n", "sketch").join(nodes, "node", "left_semi").dropDuplicates(["node"])
    sketches = written(sketches, "sketches")
    l, r = sketches.toDF("a", "ln", "left"), sketches.toDF("b", "rn", "right")
    differing = F.aggregate(
        F.zip_with("left", "right", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y
    )
    at_most = F.col("ln") + F.col("rn") - 2 * _least_shared(F.col("ln"), F.col("rn"))
    close = written(pairs.join(l, "a").join(r, "b").filter(differing <= at_most).select("a", "b"), "close")

    nodes = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    holders = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "content")).alias("row"))
    holders = written(holders.select("node", "row.*"), "holders")
    holders = broadcast_if_small(holders, holders.count())
    one = known["doc_id"].eqNullSafe(holders["doc_id"]) & (known["content"] == holders["content"])
    lists = known.join(holders, one).select("node", _shingle_lists("text").alias("shingles"))
    lists = written(lists.dropDuplicates(["node"]), "shingles")
    # Pairs carry the shingles of their first set through a shuffle: a part of them at a time, each stored before the next.
    shared = F.size(F.array_intersect("left", "right"))
    found = None
    for part in range(PARTS):
        own = F.pmod(F.hash("a"), F.lit(PARTS)) == part
        one, two = lists.toDF("a", "left").filter(own), lists.toDF("b", "right")
        both = close.filter(own).join(one, "a").join(two, "b")
        similar = written(both.filter(shared >= SIMILARITY * (F.size("left") + F.size("right") - shared)).select("a", "b"), "similar")
        found = similar if found is None else found.unionByName(similar)
    return found


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _members(docs: DataFrame) -> DataFrame:
    """``doc_id, content, root`` of every row: see ``similar_documents``. Only what later steps read stays on disk."""
    known = docs.select("doc_id", "text", _content(docs))
    made = known.select("doc_id", "content", _shingle_sets(F.col("text"), *_common(known)).alias("set"))
    sets = written(made.select("doc_id", "content", "set.*", F.monotonically_increasing_id().alias("row")), "sets")
    # One row of each set stands for all: copies are no more rows in the groups below.
    single = sets.groupBy("node").agg(F.min("row").alias("row")).select("row")

    # Sets that share a shingle of their prefixes, each beside another of them; the order differs by shingle.
    rows = sets.join(single, "row", "left_semi").select("node", "n", F.posexplode("prefix").alias("at", "key"))
    group = Window.partitionBy("key").orderBy(F.xxhash64("node", "key"), "node")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.lag(F.struct("node", "n", "at")).over(group)
    placed = rows.withColumns({"low": F.min("node").over(whole), "high": F.max("node").over(whole), "last": last})
    fresh = F.col("last").isNull() | (F.col("last.node") != F.col("node"))
    spark = docs.sparkSession
    shared_path, held_path = fresh_path(spark, "shared"), fresh_path(spark, "held")
    shared = stored(placed.filter((F.col("low") < F.col("high")) & fresh).drop("low", "high"), shared_path)

    # First these neighbours: large classes come together without all their pairs.
    beside = shared.filter("last IS NOT NULL").select(F.struct("node", "n", "at").alias("this"), "last")
    beside = beside.filter(_may_be_similar("this", "last")).select(*_ordered("this.node", "last.node")).distinct()
    edges = written_apart(spark, lambda: _similar(written(beside, "beside"), known, sets), "similar")

    # Then every pair whose sets are not in one class yet. Rows outside the commonest class of a shingle meet all others.
    roots = components(edges)
    held = shared.join(roots, "node", "left").select("key", "node", "n", "at", F.coalesce("root", "node").alias("root"))
    held = stored(held, held_path)
    delete_path(spark, shared_path)
    main = held.groupBy("key", "root").count().groupBy("key").agg(
        F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("roots")
    )
    main = main.filter("roots > 1").select("key", "main")
    both = written_apart(spark, lambda: held.join(written(main, "main"), "key"), "open")
    delete_path(spark, held_path)
    l, r = both.filter("root != main").alias("l"), both.alias("r")
    once = (F.col("r.root") == F.col("r.main")) | (F.col("l.node") < F.col("r.node"))
    other = (F.col("l.key") == F.col("r.key")) & (F.col("l.root") != F.col("r.root")) & once
    rest = l.join(r, other & _may_be_similar("l", "r")).select(*_ordered("l.node", "r.node")).distinct()
    edges = edges.unionByName(written_apart(spark, lambda: _similar(written(rest, "rest"), known, sets), "similar"))

    roots = components(edges)
    held = sets.select("doc_id", "content", "node").join(roots, "node", "left")
    return held.select("doc_id", "content", F.coalesce("root", "node").alias("root"))


def _content(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("content")


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, component_id``: classes of documents whose shingles of SIMILAR_WORDS words overlap by SIMILARITY or more.

    No pair is missed. Documents with the same shingles are one set. In any order of all shingles, two similar sets of
    sizes n share one of their first n - ceil(SIMILARITY * n) + 1: such a prefix of each set is dealt by shingle.
    Shingles that a sample has often stand last, so that few sets meet by these. Each set is first compared with one
    other at each shingle; the pairs found make classes. Then all pairs that meet and are in different classes are
    compared, so a large class costs its rows and not its pairs. Sizes, places in the prefix and sketches discard only
    pairs that can't be similar; the shingles of the rest are compared.

    ``component_id`` is the smallest doc_id of the class, null where it has none. Repeated ids give a row each time.
    """
    held = written_apart(docs.sparkSession, lambda: _members(docs), "members")
    lowest = held.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return held.join(lowest, "root").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of ``similar_documents``: that of the smallest doc_id (null last).

    Rows are told apart by id and text: a repeated doc_id with another text is another document and is judged by its own
    class. Rows that repeat both are one document and come once. Null texts are empty, and empty texts are one class. Very
    long texts are compared whole. Other columns go through, whatever their names. An empty table stays empty.
    """
    return _one_of_each(docs, written_apart(docs.sparkSession, lambda: _members(docs), "members"))


def keep_one_fingerprint(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``, chosen as in ``keep_one``."""

    def members() -> DataFrame:
        prints, named = _classes(docs.select("doc_id", _content(docs), fingerprint(docs["text"], words).alias("fp")))
        return prints.join(named.select("fp", "root"), "fp").select("doc_id", "content", "root")

    return _one_of_each(docs, written_apart(docs.sparkSession, members, "members"))


def _one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not the first of their class in ``found`` (``doc_id, content, root``)."""
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    own = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("content") == F.col("best.content"))
    gone = found.join(best, "root").filter(~own).select(F.col("doc_id").alias("id"), F.col("content").alias("of")).distinct()
    gone = written(gone, "gone")

    def listed(rows: DataFrame, those: DataFrame, how: str) -> DataFrame:
        return rows.join(those, rows["doc_id"].eqNullSafe(those["id"]) & (_content(rows) == those["of"]), how)

    again = found.groupBy(F.col("doc_id").alias("id"), F.col("content").alias("of")).count().filter("count > 1").select("id", "of")
    again = written(again, "again")
    kept = listed(docs, gone, "left_anti")
    if again.isEmpty():
        return kept
    rows = listed(kept, again, "left_semi")
    once = rows.select(F.struct("*").alias("row"), "doc_id", _content(rows)).groupBy("doc_id", "content").agg(F.first("row").alias("row"))
    return listed(kept, again, "left_anti").unionByName(once.select("row.*"))
