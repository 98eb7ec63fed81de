"""Filtering of pages by their URL: rules first, then gradient-boosted trees on lexical features.

Features come from the URL alone: lengths, depth, share of digits, entropy, parameters, and statistics of the host's
suffix over all labelled URLs. The trees are Spark's own, fitted on a bounded sample of the labelled URLs (``FIT_URLS``,
smallest hash first).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written


@dataclass(frozen=True)
class Rule:
    """A verdict on a host and its subdomains, on paths that start alike."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Labelled URLs that the fit may use at most, of each label.
FIT_URLS = 10_000
TREES, DEPTH, SEED = 12, 4, 42
#: A suffix seen seldom is drawn to the overall rate as if it had so many URLs more.
PRIOR_URLS = 10
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "dash_ratio", "entropy", "parameters", "has_fragment", "suffix_rate", "suffix_count")


def parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``: both empty for null or without ``://``. Only A-Z of the host are lower-cased."""
    at = F.locate("://", F.coalesce("url", F.lit("")))
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def rule_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct ``rule, verdict``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _lexical(pages: DataFrame) -> DataFrame:
    """Adds the features that need no other rows, and ``suffix``, the last label of the host."""
    url = F.coalesce("url", F.lit(""))
    length = F.length(url)
    ratio = lambda pattern: F.try_divide(F.length(F.regexp_replace(url, pattern, "")), length)
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (length - F.length(F.replace(url, c, F.lit("")))) / length
    entropy = F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    numbers = {
        "length": length,
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "labels": F.size(F.split("host", r"\.")),
        "digit_ratio": ratio("[^0-9]"),
        "dash_ratio": ratio("[^_.-]"),
        "entropy": entropy,
        "parameters": F.length(F.regexp_replace(url, "[^=]", "")),
        "has_fragment": F.contains(url, F.lit("#")),
    }
    numbers = {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in numbers.items()}
    return pages.withColumns(numbers | {"suffix": F.substring_index("host", ".", -1)})


def _with_suffixes(rows: DataFrame, statistics: DataFrame, overall: float) -> DataFrame:
    """Adds ``suffix_rate`` and ``suffix_count``; an unseen suffix has the overall rate."""
    return rows.join(statistics, "suffix", "left").withColumns(
        {"suffix_rate": F.coalesce("suffix_rate", F.lit(overall)), "suffix_count": F.coalesce("suffix_count", F.lit(0.0))}
    )


def block_chance(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """``pages`` (with ``url, host, path``) and ``chance``, that of being blocked.

    ``labelled`` has ``url, host, path, label`` (1: block). With rows of one label only, or none, every chance is that
    label's share (0 without rows).
    """
    kept = pages.columns
    labelled = written(_lexical(labelled.select("url", "host", "path", "label")), "labelled")
    totals = labelled.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("rate")).first()
    rows = _lexical(pages)
    if not totals.n or totals.rate in (0.0, 1.0):
        return rows.select(*kept, F.lit(float(totals.rate)).alias("chance"))
    statistics = labelled.groupBy("suffix").agg(
        ((F.sum("label") + PRIOR_URLS * totals.rate) / (F.count("*") + PRIOR_URLS)).alias("suffix_rate"),
        F.log1p(F.count("*").cast("double")).alias("suffix_count"),
    )
    statistics = written(statistics, "suffixes")
    order = [F.xxhash64("url"), F.col("url")]
    picked = [labelled.filter(F.col("label") == y).orderBy(*order).limit(FIT_URLS) for y in (0, 1)]
    sample = _with_suffixes(picked[0].unionByName(picked[1]), statistics, totals.rate)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    sample = written(assembler.transform(sample).select("features", F.col("label").cast("double").alias("label")), "fit").coalesce(4)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(sample)
    scored = model.transform(assembler.transform(_with_suffixes(rows, statistics, totals.rate)))
    return scored.select(*kept, vector_to_array("probability")[1].alias("chance"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, chance`` for every page (``page_id, url``).

    The rules decide first. The trees decide the rest, and give every page its chance; they learn from ``labelled``
    (``url, label``) or else from the URLs that the rules decide. A chance of one half or more blocks. Null URLs are
    judged as empty ones. Repeated rows are judged alike, each. Other columns are ignored.
    """
    ruled = parts(pages.select("page_id", "url")).withColumn("r", rule_of(rules))
    if labelled is None:
        known = ruled.filter("r IS NOT NULL").withColumn("label", F.when(F.col("r.verdict") == "block", 1).otherwise(0))
    else:
        known = parts(labelled.select("url", "label").filter("label IS NOT NULL"))
    return block_chance(ruled, known).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(F.col("chance") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "chance",
    )
