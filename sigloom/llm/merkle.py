"""Document fingerprints as Merkle trees over sections, paragraphs and pieces of paragraphs.

A paragraph is a line. Its pieces are runs of words that end where a word's last character says so, and together they are
the whole line; an edit moves no other piece's borders for long. A section ends after a paragraph whose hash says so (one in
``SECTION_PARAGRAPHS``) or that is blank. Pieces are the leaves, by SHA-256; a paragraph's branch hashes its leaves, a
section's its paragraphs, the root its sections. Equal roots mean equal texts, the branches that differ lead to the edited
paragraphs, and the leaves that two trees share tell how much the texts have in common. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.shared_storage import written

SECTION_PARAGRAPHS = 8
#: Words of a piece: at least two unless its line is shorter, and at most so many.
PIECE_WORDS = 16
#: Characters of a run without white space from which it is cut inside.
LONG_WORD = 24
#: Documents whose texts meet in one group, about, when each is laid beside the next one.
GROUP_DOCS = 500
#: Ranges of ids that are counted to form the groups: one for so many documents, and at most 2^18. The table of them is
#: broadcast, some 50 bytes a range.
RANGE_DOCS, ID_RANGES = 16, 1 << 18
#: Ranges are equal steps between two neighbours of so many quantiles of the ids, so outlying ids widen no other's range.
QUANTILES = 256

#: Pieces end after words that end so: visible ASCII of even code except letters in upper case, and marks of wide scripts.
_END = "[" + "".join(f"\\x{c:02x}" for c in range(0x22, 0x7F, 2) if not chr(c).isupper()) + r"\u3000-\u303F\uFF00-\uFF0F\uFF1A-\uFF1F]"
_PIECE = (
    rf"\s*+\S{{{LONG_WORD},}}?{_END}\s*+"  # inside a run without white space
    rf"|\s*+(?:\S++\s++){{1,{PIECE_WORDS - 1}}}?\S++(?<={_END})\s*+"
    rf"|\s*+(?:\S++\s++){{0,{PIECE_WORDS - 1}}}\S++\s*+"
    r"|\s++"
)


def _leaves(line: Column) -> Column:
    return F.transform(F.regexp_extract_all(line, F.lit(_PIECE), F.lit(0)), lambda piece: F.sha2(piece, 256))


def _branch(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def tree(text: Column) -> Column:
    """``root``, ``sections`` (their branches), ``starts`` (their first paragraphs from 0), ``paragraphs`` (their branches)
    and ``pieces`` (the different leaves), all hashes in 64 hex digits. Null is the empty text: one blank paragraph, no pieces.
    Very long texts are hashed whole.
    """
    blank = F.sha2(F.lit(""), 256)

    def sections(branches: Column) -> Column:
        def closes(branch: Column) -> Column:
            return (F.pmod(F.xxhash64(branch), F.lit(SECTION_PARAGRAPHS)) == 0) | (branch == blank)

        last = F.filter(F.sequence(F.lit(1), F.size(branches)), lambda k: (k == F.size(branches)) | closes(F.get(branches, k - 1)))
        return _bound(
            last,
            lambda ends: F.transform(
                ends, lambda end, k: F.struct(F.when(k == 0, 0).otherwise(F.get(ends, F.greatest(k - 1, F.lit(0)))).alias("start"), end.alias("end"))
            ),
        )

    def above(leaves: Column, branches: Column) -> Column:
        def with_sections(spans: Column) -> Column:
            return _bound(
                F.transform(spans, lambda s: _branch(F.slice(branches, s["start"] + 1, s["end"] - s["start"]))),
                lambda nodes: F.struct(
                    _branch(nodes).alias("root"),
                    nodes.alias("sections"),
                    F.transform(spans, lambda s: s["start"]).alias("starts"),
                    branches.alias("paragraphs"),
                    F.array_distinct(F.flatten(leaves)).alias("pieces"),
                ),
            )

        return _bound(sections(branches), with_sections)

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return _bound(F.transform(lines, _leaves), lambda leaves: _bound(F.transform(leaves, _branch), lambda branches: above(leaves, branches)))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def likeness(left: Column, right: Column) -> Column:
    """Of the pieces of two trees: twice the shared ones over all, 1 for two texts without pieces."""
    both = F.size(left) + F.size(right)
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(left, right)) / both)


def tree_likeness(left: Column, right: Column) -> Column:
    """1 for equal roots, else the likeness of the leaves. Texts that differ in nothing but the order of their pieces also
    have 1, and different roots."""
    return F.when(left["root"] == right["root"], 1.0).otherwise(likeness(left["pieces"], right["pieces"]))


def changed_paragraphs(old: Column, new: Column) -> Column:
    """The paragraphs of ``new`` (from 0), a tree, that aren't in ``old``: none for equal roots, else only differing
    sections are looked into. With the trees exchanged: the paragraphs that are gone.
    """
    differing = F.filter(F.arrays_zip(new["sections"].alias("branch"), new["starts"].alias("start")), lambda s: ~F.array_contains(old["sections"], s["branch"]))
    size = F.size(new["paragraphs"])
    ends = F.transform(differing, lambda s: F.coalesce(F.array_min(F.filter(new["starts"], lambda x: x > s["start"])), size))
    inside = F.flatten(F.transform(F.arrays_zip(differing.alias("s"), ends.alias("end")), lambda x: F.sequence(x["s"]["start"], x["end"] - 1)))
    return F.when(old["root"] == new["root"], F.array().cast("array<int>")).otherwise(
        F.filter(inside, lambda k: ~F.array_contains(old["paragraphs"], F.get(new["paragraphs"], k)))
    )


def _shared(one: Column, other: Column) -> Column:
    """``node, at`` of the paragraphs of ``one`` that ``other`` has too, in order."""
    placed = F.transform(one["paragraphs"], lambda p, k: F.struct(p.alias("node"), k.alias("at")))
    return F.filter(placed, lambda x: F.array_contains(other["paragraphs"], x["node"]))


def edits(old: Column, new: Column) -> Column:
    """What leads from one tree to the other, by paragraphs from 0: ``added`` and ``moved`` in ``new``, ``gone`` in ``old``.

    Moved are shared paragraphs where the shared ones of both sides, laid side by side in order, differ.
    """

    def moved(before: Column, after: Column) -> Column:
        differing = F.filter(
            F.transform(after, lambda x, k: F.struct(x["at"].alias("at"), (x["node"] == F.get(before, k)["node"]).alias("same"))),
            lambda x: ~F.coalesce(x["same"], F.lit(False)),
        )
        return F.transform(differing, lambda x: x["at"])

    order = F.when(old["root"] == new["root"], F.array().cast("array<int>")).otherwise(
        _bound(_shared(old, new), lambda before: _bound(_shared(new, old), lambda after: moved(before, after)))
    )
    return F.struct(changed_paragraphs(old, new).alias("added"), changed_paragraphs(new, old).alias("gone"), order.alias("moved"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, pieces`` of every row, the pieces being the tree's. Other columns are ignored; no rows give none."""
    # The generator keeps the optimizer from making the tree twice.
    trees = docs.select("doc_id", F.explode(F.array(tree(F.col("text")))).alias("tree"))
    return trees.select("doc_id", "tree", F.col("tree.pieces").alias("pieces"))


def compared(rows: DataFrame) -> DataFrame:
    """Adds to ``text, edited, next_text`` the roots ``fingerprint, edited_fingerprint`` and the likenesses of the trees
    ``near_edited, near_next``. Each tree is made once."""
    trees = F.array(*[tree(F.col(c)) for c in ("text", "edited", "next_text")])

    def told(t: Column) -> Column:
        own, changed, following = (F.get(t, F.lit(k)) for k in range(3))
        return F.struct(
            own["root"].alias("fingerprint"),
            changed["root"].alias("edited_fingerprint"),
            tree_likeness(own, changed).alias("near_edited"),
            tree_likeness(own, following).alias("near_next"),
        )

    return rows.select("*", F.inline(F.transform(F.array(trees), told)))


def _range(doc_id: Column, lows: list[int], steps: list[int], per: int) -> Column:
    """The number of an id's range: the quantile it lies behind, then the step from there. It never falls as ids rise."""
    behind = F.size(F.filter(F.array(*[F.lit(x) for x in lows]).cast("array<long>"), lambda x: x <= doc_id)) - 1

    def stepped(k: Column) -> Column:
        low, step = (F.get(F.array(*[F.lit(x) for x in values]).cast("array<long>"), k) for values in (lows, steps))
        return k * F.lit(per).cast("long") + F.least(F.floor((doc_id - low) / step).cast("long"), F.lit(per - 1).cast("long"))

    return F.when(doc_id.isNotNull(), _bound(behind, stepped))


def _groups(docs: DataFrame) -> tuple[DataFrame, Column]:
    """``range, group, first``: groups of neighbouring ranges of ids, about GROUP_DOCS documents each and numbered without
    gaps; ``first`` is the smallest id of the group on the group's first range, else null. Beside it how an id finds its range.
    """
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    shares = F.array(*[F.lit(k / QUANTILES) for k in range(QUANTILES)])
    bounds = ids.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), F.percentile_approx("doc_id", shares, 10_000).alias("marks")).first()
    lows = sorted({bounds.low, *bounds.marks}) if bounds.n else [0]
    per = max(1, min(ID_RANGES, bounds.n // RANGE_DOCS) // len(lows))
    steps = [max(1, -(-(end - low) // per)) for low, end in zip(lows, [*lows[1:], (bounds.high or 0) + 1])]
    own = _range(F.col("doc_id"), lows, steps, per)
    counted = ids.groupBy(own.alias("range")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    order = Window.orderBy("range")  # ID_RANGES rows at most
    numbered = counted.withColumn("slot", F.floor((F.sum("n").over(order) - F.col("n")) / GROUP_DOCS)).withColumn("group", F.dense_rank().over(Window.orderBy("slot")))
    new = F.coalesce(F.lag("group").over(order) != F.col("group"), F.lit(True))
    return written(numbered.select("range", "group", F.when(new, F.col("first")).alias("first")), "groups"), own


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text`` with the text of the next row by doc_id, then text; after the last comes the first.

    Null ids stand before all others, null texts are empty. Ids are whole numbers; rows of one id are one group. Other columns are
    ignored, and no rows give none. Texts are shuffled once, in groups of neighbouring ids; the first document of a group is
    also the end of the group before.
    """
    groups, id_range = _groups(docs)
    last = groups.agg(F.max("group").alias("last")).first().last or 0
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("range", id_range)
    placed = own.join(F.broadcast(groups), "range", "left").withColumn("group", F.coalesce("group", F.lit(0)))
    # Group 0 holds null ids. The first of group g also goes to g - 1, the very first to the very end.
    has_null = not docs.filter("doc_id IS NULL").isEmpty()
    begin = 0 if has_null else 1
    opens = (F.col("first") == F.col("doc_id")) if not has_null else ((F.col("first") == F.col("doc_id")) | F.col("doc_id").isNull())
    here = F.struct(F.col("group").alias("group"), F.lit(True).alias("own"), F.lit(0).alias("turn"))
    there = F.struct(
        F.when(F.col("group") == begin, last).otherwise(F.col("group") - 1).alias("group"),
        F.lit(False).alias("own"),
        F.when(F.col("group") == begin, 1).otherwise(0).alias("turn"),
    )
    copies = placed.select("doc_id", "text", F.explode(F.when(F.coalesce(opens, F.lit(False)), F.array(here, there)).otherwise(F.array(here))).alias("at"))
    order = Window.partitionBy("at.group").orderBy("at.turn", F.col("doc_id").asc_nulls_first(), "text", F.col("at.own").desc())
    return copies.withColumn("next_text", F.lead("text").over(order)).filter("at.own").select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half, rounded down, replaced by the beginning of the next one, as long or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
