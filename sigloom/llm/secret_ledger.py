"""Secrets in every historical version of every path, scanning each content once per version of a rule.

A content is addressed by its SHA-256. The ledger is a table ``blob, rule, version, spans`` of what has been scanned; a
scan takes only the pairs of content and rule version that it lacks, adds them, and joins the spans back to all paths
and versions that hold the content. A raised rule version is scanned again, an unchanged one never. The ledger only
grows by whole appended folders: a run that is lost halfway leaves no rows, and running it again is safe.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.spans import SPANS
from sigloom.shared_storage import fresh_path, path_exists, written

LEDGER_SCHEMA = f"blob string, rule string, version int, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """What a rule finds: leftmost matches without overlap; those with ``group`` shorter than ``least`` are dropped.

    With ``closing``, ``pattern`` opens and ``closing`` closes a span with any text between, however long. Of several openings
    before a closing the last one counts; one pass over the text pairs them.
    """

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    base: bool = False
    closing: str = ""


# The base rules, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
)
#: What the base rules don't know: keys in blocks, signed tokens, tokens of known services, passwords in addresses.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 2, closing=r"-----END [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("signed_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("service_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"),
    Rule("address_password", r"\b[a-z][a-z0-9+]{1,15}://[^\s/:@]++:[^\s/@]{3,}+@", 2),
)
RULES = BASE_RULES + MORE_RULES

#: Up to so many unseen blobs are broadcast, some 20 MB.
PICKED_BLOBS = 100_000

_RUN = re.compile(r"[0-9a-f]{24,}")


def _paired(compiled: re.Pattern, closing: re.Pattern, text: str) -> list[tuple[int, int]]:
    """From each closing mark back to the last opening one before it that no other closing mark has."""
    marks = [(m.start(), m.end(), False) for m in compiled.finditer(text)]
    marks += [(m.start(), m.end(), True) for m in closing.finditer(text)] if marks else []
    out, opened = [], None
    for start, end, closes in sorted(marks):
        if closes and opened is not None:
            out.append((opened, end))
        opened = None if closes else start
    return out


def _matches(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    if rule.closing:
        return _paired(compiled, re.compile(rule.closing, re.ASCII), text)
    if rule.pattern == r"[0-9a-f]+" and rule.least == 24:
        compiled = _RUN  # the same runs, without visiting the short ones
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(text: Column, wanted: Column, rules: tuple[Rule, ...]) -> Column:
    """For each wanted rule name its spans."""

    @F.arrow_udf(f"array<struct<rule:string,spans:{SPANS}>>")
    def scan(texts: pa.Array, names: pa.Array) -> pa.Array:
        compiled = {r.name: (r, re.compile(r.pattern, re.ASCII)) for r in rules}
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        out = []
        for text, wants in zip(texts, names):
            whole, found = text.as_py(), []
            for name in wants.as_py():
                rule, pattern = compiled[name]
                places = [{"kind": name, "start": s, "end": e, "base": rule.base} for s, e in _matches(rule, pattern, whole)]
                found.append({"rule": name, "spans": places})
            out.append(found)
        return pa.array(out, type=pa.list_(pa.struct([("rule", pa.string()), ("spans", spans)])))

    return scan(text, wanted)


def scan_history(history: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, revision, blob, spans`` for every row of ``history`` (``path, revision, content``).

    ``spans`` holds the findings of the current versions of all rules by start, then rule as listed. ``ledger`` is the
    folder of the ledger, made where there is none; without a folder a new one in the shared folder is used. A null
    content counts as the empty one. Repeated rows come as often as they are given; null paths and revisions are kept.
    Other columns are ignored. Two scans must not add to one ledger at the same time.
    """
    spark = history.sparkSession
    ledger = ledger or fresh_path(spark, "ledger")
    content = F.coalesce("content", F.lit(""))
    history = history.select("path", "revision", content.alias("content"))
    versions = written(history.select("path", "revision", F.sha2("content", 256).alias("blob")), "versions")

    current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    blobs = versions.select("blob").distinct()
    needed = blobs.select("blob", F.explode(current).alias("r")).select("blob", "r.rule", "r.version")
    if path_exists(spark, ledger):
        known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
        needed = needed.join(known.select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti")
    unseen = written(needed.groupBy("blob").agg(F.collect_set("rule").alias("rules")), "unseen")

    # One text of each unseen blob is scanned. Copies are dropped before the shuffle as far as a task sees them. A small
    # addition to a known history is picked first; else all blobs are needed anyway.
    texts = history.select(F.sha2("content", 256).alias("blob"), "content")
    if unseen.count() <= PICKED_BLOBS:
        texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
    texts = texts.dropDuplicates(["blob"])
    scanned = texts.join(unseen, "blob").select("blob", F.explode(_scan(F.col("content"), F.col("rules"), rules)).alias("f"))
    version = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.version))])
    scanned.select("blob", "f.rule", version[F.col("f.rule")].alias("version"), "f.spans").write.mode("append").parquet(ledger)

    known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("rule") == r.name) & (F.col("version") == r.version))
    rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    keyed = F.transform(
        F.flatten(F.collect_list("spans")),
        lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s.alias("span")),
    )
    # A blob has one row for each rule, so its list is bounded by what one text holds; a clean one needs no row at all.
    spans = known.filter(wanted & (F.size("spans") > 0)).groupBy("blob").agg(
        F.transform(F.array_sort(keyed), lambda x: x["span"]).alias("spans")
    )
    return versions.join(spans, "blob", "left").select(
        "path", "revision", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )
