"""Benchmark passages in documents, found by spaced seeds and verified with room for substitutions.

Texts are lower-cased and cut into tokens of letters and digits. A seed is what a fixed mask sees of eight consecutive
tokens: it ignores some of the positions, so substitutions there don't hide a match. The three masks together ignore
every position once or more. Seeds of the benchmark are joined with those of all documents; around each hit the item is
laid over the document and the tokens are compared.

An item is in a document if a window of ``min(16, length of the item)`` of its tokens stands there with no more than
``allowed_substitutions`` different tokens: 3 in 16, 1 in 8 to 15, none in fewer. Nothing that meets this is missed: 16
tokens are two blocks of eight of which one holds at most one substitution, and some mask ignores its position. Items of
fewer than eight tokens are looked for as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written

SPAN = 8
#: Positions of a seed that each mask looks at.
MASKS = ((1, 2, 4, 5, 7), (0, 2, 3, 5, 6), (0, 1, 3, 4, 6, 7))
WINDOW = 16
#: Seeds of the benchmark that are broadcast, some 100 MB in an executor; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Hashes of the tokens. Null: none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.hash(w))


def _short_seed(parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(-len(parts)), *parts)


def _seed_rows(rows: DataFrame, keep: list[str], hashes: Column, short: list[int]) -> DataFrame:
    """``keep, at, seed``: a row for each seed; ``short`` are the lengths of items that no mask fits on.

    The hashes are laid side by side with themselves, shifted by one to seven tokens, so that a row holds what a seed
    needs and the seeds are plain expressions over columns.
    """
    h = F.col("_hashes")
    shifted = [h.alias("a0"), *[F.slice(h, p + 1, F.size(h)).alias(f"a{p}") for p in range(1, SPAN)]]
    at = rows.select(*keep, hashes.alias("_hashes")).select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("at", "a"))
    a = [F.col("a")[f"a{p}"] for p in range(SPAN)]
    seeds = [F.when(a[-1].isNotNull(), F.xxhash64(F.lit(k), *[a[p] for p in mask])) for k, mask in enumerate(MASKS)]
    seeds += [F.when(a[n - 1].isNotNull(), _short_seed(a[:n])) for n in short]
    return at.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed")).filter("seed IS NOT NULL")


def allowed_substitutions(window: Column) -> Column:
    return F.when(window >= WINDOW, 3).when(window >= SPAN, 1).otherwise(0)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that is in it:

    ``doc_id, item_id, window_tokens, equal_tokens`` of the best window, ``first_token`` of it in the document, and
    ``item_equal_tokens``, how many tokens of the whole item stand in place around it. Ties: the most equal tokens, then
    the item's most equal tokens, then the smallest place. Items that repeat an item_id with another text are items of
    their own and come as one row, the best. Items without tokens and null texts are in nothing. Rows that repeat a
    doc_id come as one row; a null doc_id is one document id like any other. Other columns are ignored.
    """
    items = benchmark.select("item_id", tokens(F.col("text")).alias("item")).filter(F.size("item") > 0).distinct()
    items = written(items.withColumn("length", F.size("item")), "items")
    short = sorted(r.length for r in items.filter(F.col("length") < SPAN).select("length").distinct().collect())  # 1 to 7

    items = items.withColumn("item_hash", F.xxhash64("item"))
    seeds = _seed_rows(items.filter(F.col("length") >= SPAN), ["item_id", "item_hash"], F.col("item"), [])
    for n in short:
        seed = _short_seed([F.get("item", F.lit(p)) for p in range(n)])
        whole = items.filter(F.col("length") == n).select("item_id", "item_hash", F.lit(0).alias("at"), seed.alias("seed"))
        seeds = seeds.unionByName(whole)
    seeds = written(seeds.withColumnRenamed("at", "item_at"), "seeds")

    # First pass: which items to lay where. Only seeds leave the rows, never the texts. A row is known by its key, so
    # that rows of one id, null or repeated, never meet each other's places.
    docs = docs.select(row_key(docs).alias("key"), "doc_id", "text")
    hashed = _seed_rows(docs, ["key"], tokens(F.col("text")), short)
    found = hashed.join(F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds, "seed")
    places = written(
        found.select("key", "item_id", "item_hash", (F.col("at") - F.col("item_at")).alias("place")).distinct(), "places"
    )

    # Second pass: the texts of documents with a hit, once for each of them.
    hit = places.select("key").distinct()
    texts = docs.join(hit, "key").select("key", "doc_id", tokens(F.col("text")).alias("doc"))
    whole = items.alias("i")
    laid = places.alias("p").join(
        whole, F.col("p.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("p.item_hash") == F.col("i.item_hash"))
    ).select("p.key", "p.item_id", "p.place", "i.item")
    both = texts.join(laid, "key").select("doc_id", "item_id", "place", _facing("doc", "item", "place").alias("equal"))
    return _verified(both)


def row_key(docs: DataFrame) -> Column:
    """A hash of id and text; rows that repeat both are one."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit("")))


def _facing(doc: str, item: str, place: str) -> Column:
    """For each token of the item: 1 if the document has it at its place."""
    at = F.col(place)
    return F.transform(
        F.col(item), lambda x, k: F.when((at + k >= 0) & (F.get(F.col(doc), F.greatest(at + k, F.lit(0))) == x), 1).otherwise(0)
    )


def _verified(both: DataFrame) -> DataFrame:
    window = F.least(F.lit(WINDOW), F.size("equal"))
    sums = F.transform(
        F.sequence(F.lit(0), F.size("equal") - window),
        lambda k: F.struct(
            F.aggregate(F.slice(F.col("equal"), k + 1, window), F.lit(0), lambda a, x: a + x).alias("equal"), (-k).alias("before")
        ),
    )
    best = both.select(
        "doc_id", "item_id", "place", window.alias("window"), F.array_max(sums).alias("best"),
        F.aggregate("equal", F.lit(0), lambda a, x: a + x).alias("all"),
    ).filter(F.col("window") - F.col("best.equal") <= allowed_substitutions(F.col("window")))
    first = F.col("place") - F.col("best.before")
    row = F.struct(F.col("best.equal").alias("equal"), "all", (-first).alias("before"), "window")
    return best.groupBy("doc_id", "item_id").agg(F.max(row).alias("row")).select(
        "doc_id", "item_id", F.col("row.window").cast("long").alias("window_tokens"),
        F.col("row.equal").cast("long").alias("equal_tokens"), (-F.col("row.before")).cast("long").alias("first_token"),
        F.col("row.all").cast("long").alias("item_equal_tokens"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item, each row by its own text.

    Null texts hold nothing; null and repeated ids are rows like others. Very long texts are searched whole. Other columns
    go through, whatever their names. Empty tables: no rows go.
    """
    keyed = docs.select(row_key(docs).alias("doc_id"), "text")
    leaks = written(overlaps(keyed, benchmark).select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return docs.join(leaks, row_key(docs) == leaks["key"], "left_anti")
