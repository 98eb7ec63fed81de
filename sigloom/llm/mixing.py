"""Mixing sources to target weights by thresholds on a hash, found in nested histograms.

Each document has a hash of its id. A source takes every document a whole number of times and, for what its target has
left, those with a hash below a threshold. The threshold comes from a histogram of words by hash bucket: whole buckets
under the budget are in, and only the bucket at the boundary is split again, by the next bits. Documents are never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.shared_storage import written

#: Weights of sources in code point order, repeating, and what they share, as a part of all words.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
#: A target stops at so many times its source's words.
MOST_TIMES = 2
#: Bits of the hash, and of one level of the histogram.
HASH_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Runs without ASCII white space. Null: 0."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(squeezed, " \t\n\x0b\x0c\r", "")).cast("long")


def spread_hash(doc_id: Column) -> Column:
    """The first 60 bits of the id's MD5. A null id counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to ``source, source_size``, one row per source (null last).

    Sources share SHARE times all words by weight; what goes beyond MOST_TIMES a source's words is shared again among
    the others. That ends with one common share per weight: sources whose limit is below it have their limit. Ordered
    by limit per weight, it is what the limits before leave, over the weights from there on, where that is largest.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(order) - 1) % len(WEIGHTS)) + 1)
    ).withColumn("limit", F.col("source_size") * MOST_TIMES)
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * SHARE
    shared = weighed.withColumn("share", (total - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after))
    return shared.withColumn("share", F.max("share").over(everything)).select(
        "source", "source_size", F.least(F.col("limit").cast("double"), F.col("share") * F.col("weight")).alias("target")
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Adds ``times`` and ``below`` to ``source, source_size, target``.

    A source takes all documents ``times`` times and once more those with a hash under ``below``. ``sized`` needs
    ``source, hash, size``.
    """
    state = goals.withColumn("times", F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double")))).withColumn(
        "times", F.coalesce("times", F.lit(0)).cast("long")
    )
    state = state.withColumn("budget", F.col("target") - F.col("times") * F.col("source_size")).withColumn("prefix", F.lit(0).cast("long"))
    state = written(state, "budgets")
    done = 0
    while done < HASH_BITS:
        done += LEVEL_BITS
        shift = HASH_BITS - done
        d, s = sized.alias("d"), state.alias("s")
        inside = F.shiftright(F.col("d.hash"), shift + LEVEL_BITS) == F.col("s.prefix")
        boundary = d.join(s, _same("d.source", "s.source") & inside)
        histogram = boundary.groupBy(F.col("s.source").alias("source"), F.shiftright("d.hash", shift).alias("bucket")).agg(
            F.sum("d.size").alias("words")
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        h = histogram.withColumn("upto", F.sum("words").over(upto)).alias("h")
        # The boundary is the first bucket that goes beyond the budget; without one everything here is in.
        split = s.join(h, _same("s.source", "h.source"), "left").groupBy(*[F.col(f"s.{c}") for c in state.columns]).agg(
            F.min(F.when(F.col("h.upto") > F.col("s.budget"), F.struct("h.bucket", (F.col("h.upto") - F.col("h.words")).alias("under")))).alias("at")
        )
        beyond = F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)
        state = written(
            split.select(
                "source", "source_size", "target", "times",
                (F.col("budget") - F.coalesce(F.col("at.under"), F.lit(0))).alias("budget"),
                F.coalesce(F.col("at.bucket"), beyond).alias("prefix"),
            ),
            "budgets",
        )
    return state.select("source", "source_size", "target", "times", F.col("prefix").alias("below"))


def _limits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes of all rows, and ``thresholds`` of every source."""
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), spread_hash(F.col("doc_id")).alias("hash")), "sizes"
    )
    goals = targets(written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources"))
    return sized, thresholds(sized, goals)


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``size`` is its words, ``taken`` how many of them, repeats counted, the mix takes: never above MOST_TIMES its size.
    Sums of ``taken`` fall short of the target by less than the document at the threshold. Repeated ids share a hash
    and a fate; null ids count as the empty id, null sources are one source, null texts have no words. No rows: none.
    Other columns are ignored, clashing names included.
    """
    sized, limits = _limits(docs)
    taken = F.col("d.size") * (F.col("l.times") + F.when(F.col("d.hash") < F.col("l.below"), 1).otherwise(0))
    return sized.alias("d").join(limits.alias("l"), _same("d.source", "l.source")).select(
        "d.doc_id", "d.size", "l.source_size", "l.target", taken.alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` that the mix takes, with ``taken_words`` in place of any column of that name.

    Every row is decided by its own id, source and text: rows of a repeated doc_id share a hash, so they share their fate
    within a source. Null ids count as the empty id, null sources are one source. Rows without words, null texts among
    them, are never taken. Very long texts count whole. No rows: none.
    """
    l = _limits(docs)[1].select("source", "times", "below").alias("l")
    d = docs.drop("taken_words").alias("d")
    more = spread_hash(F.col("d.doc_id")) < F.col("l.below")
    chosen = d.join(l, _same("d.source", "l.source")).filter(F.col("d.text").rlike(r"[^\x20\x09-\x0D]") & ((F.col("l.times") > 0) | more))
    taken = word_count(F.col("d.text")) * (F.col("l.times") + F.when(more, 1).otherwise(0))
    return chosen.select("d.*", taken.alias("taken_words"))
