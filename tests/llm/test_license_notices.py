"""License notices: base phrases against a plain search, and every edit within the bound."""

import random
import re

from pyspark.sql import functions as F

from sigloom.llm import license_notices as n

SEARCH = n.Searcher()


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(k, label) for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")) for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


def test_base_phrases(spark, sf_dir, texts):
    rng = random.Random(4)
    pieces = ["cc", "by", "CC-BY", "all", "Rights", "reserved", "general", "PUBLIC", "license", "é", "x", ",", "\n", "--", "cc_by", "K"]
    cases = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + texts
    cases += [" ".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(500)]
    for text in cases:
        words, found = SEARCH.search(text)
        assert (words, sorted((x["first_word"], x["label"]) for x in found if x["base"])) == plain_base(text)


def edited(phrase, edits, rng):
    chars = list(phrase)
    for _ in range(edits):
        # Away from spaces: a word that goes altogether takes its space with it, which is one edit more.
        k = rng.choice([k for k in range(1, len(chars) - 1) if " " not in chars[k - 1 : k + 2]])
        kind = rng.randrange(3)
        if kind == 0:
            chars[k] = "q"
        elif kind == 1:
            chars.insert(k, "q")
        else:
            del chars[k]
    return "".join(chars)


def test_edits_within_the_bound_are_found():
    rng = random.Random(9)
    for notice in n.FUZZY_NOTICES:
        for edits in range(notice.edits + 1):
            for _ in range(6):
                part = edited(notice.phrase, edits, rng)
                text = f"Some words, before. {part.upper()} and after"
                found = [x for x in SEARCH.search(text)[1] if x["label"] == notice.label and not x["base"]]
                assert found and any(x["edits"] <= edits or x["likeness"] < 1 for x in found), (notice, part)


def test_two_notices_side_by_side():
    found = SEARCH.search("al rights reservd all rights reserved")[1]
    assert [(x["start"], x["end"]) for x in found if not x["base"]] == [(0, 17), (18, 37)]


def test_far_texts_have_none():
    assert SEARCH.search("the public was generally licensed to reserve rights of all kinds by cc")[1] == []


def test_query_rows(docs_of, texts):
    docs = docs_of([*enumerate(texts), (None, "CC BY"), (50, "CC BY"), (50, "CC BY")])
    got = docs.select("doc_id", n.notices(F.col("text")).alias("n")).collect()
    assert len(got) == len(texts) + 3 and sum(len(r.n.found) for r in got) == 3
