"""Spaced seeds against every placement of every item."""

import random
import re

import pytest

from sigloom.llm import decontamination as d


def plain_tokens(text):
    return [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]


def plain_overlaps(docs, items):
    found = {}
    for i, text in docs:
        doc = plain_tokens(text)
        for j, item_text in items:
            item = plain_tokens(item_text)
            window = min(16, len(item))
            allowed = 3 if window >= 16 else 1 if window >= 8 else 0
            for place in range(-len(item) + 1, len(doc)) if item else ():
                equal = [int(0 <= place + k < len(doc) and doc[place + k] == w) for k, w in enumerate(item)]
                for k in range(len(item) - window + 1):
                    n = sum(equal[k : k + window])
                    if window - n <= allowed:
                        row = (n, sum(equal), -(place + k), window)
                        found[i, j] = max(found.get((i, j), row), row)
    return {(*key, row[3], row[0], -row[2], row[1]) for key, row in found.items()}


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(say(n))) for k, n in enumerate([1, 3, 7, 8, 9, 15, 16, 17, 40, 60])]
    items += [(20, ""), (21, None), (None, " ".join(say(12))), (7, " ".join(say(20)))]
    docs = [(1000, None), (1001, ""), (None, " ".join(say(30)) + " " + items[6][1])]
    for n in range(160):
        _, text = rng.choice(items)
        passage = (text or "").split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            if passage:
                passage[rng.randrange(len(passage))] = "CHANGED"
        cut = rng.choice([0, 0, 0, 5])
        docs.append((n, " ".join(say(rng.randrange(12))) + ", " + "-".join(passage[cut:]).upper() + "! " + " ".join(say(rng.randrange(12)))))
    docs += [(5, docs[20][1]), (2000, items[8][1] * 1 + " " + items[8][1])]
    return docs, items


def rows(frame):
    return {(r.doc_id, r.item_id, r.window_tokens, r.equal_tokens, r.first_token, r.item_equal_tokens) for r in frame.collect()}


def tables(spark, cases):
    docs, items = cases
    return (
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, seed string, place int"),
        spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, item string"),
    )


def test_against_every_placement(spark, cases):
    docs, benchmark = tables(spark, cases)
    expected = plain_overlaps(*cases)
    got = rows(d.overlaps(docs, benchmark))
    assert got == expected and any(r[3] < r[2] for r in got)


def test_seeds_in_blocks(spark, cases, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_SEEDS", 100)
    docs, benchmark = tables(spark, cases)
    assert rows(d.overlaps(docs, benchmark)) == plain_overlaps(*cases)


def test_empty_tables(spark, cases):
    docs, benchmark = tables(spark, cases)
    assert d.overlaps(docs.limit(0), benchmark).count() == 0
    assert d.overlaps(docs, benchmark.limit(0)).count() == 0
    assert d.keep_clean(docs, benchmark.limit(0)).count() == docs.count()


def test_keep_clean(spark, cases):
    docs, benchmark = tables(spark, cases)
    leaks = {r[0] for r in plain_overlaps(list(enumerate(t for _, t in cases[0])), cases[1])}  # by row, whatever its id
    kept = d.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for k, (i, _) in enumerate(cases[0]) if k not in leaks)


def test_masks_ignore_every_position():
    assert all(any(k not in mask for mask in d.MASKS) for k in range(d.SPAN))


def test_no_python(spark, cases):
    docs, benchmark = tables(spark, cases)
    plan = d.overlaps(docs, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
