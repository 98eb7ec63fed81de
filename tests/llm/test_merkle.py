"""Merkle fingerprints: neighbours and edits against plain Python, and where edits are found."""

import re
from hashlib import sha256

import xxhash

from pyspark.sql import functions as F

from sigloom.llm import merkle, queries


def test_neighbours_and_edited_texts(docs_of, texts, monkeypatch):
    monkeypatch.setattr(merkle, "GROUP_DOCS", 3)
    monkeypatch.setattr(merkle, "RANGE_DOCS", 1)
    for ids in (range(10), [7 * k * k - 90 for k in range(10)], [None, None, 1, 1, 1, 2, 10**12, 10**12 + 1, 10**12 + 2, -5], [4] * 10):
        rows = list(zip(ids, texts))
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
        expected = [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]
        got = [tuple(r) for r in merkle.with_next(docs_of(rows)).collect()]
        assert sorted(map(str, got)) == sorted(map(str, expected))
        shown = merkle.with_next(docs_of(rows)).select(merkle.edited(F.col("text"), F.col("next_text")).alias("e")).collect()
        assert sorted(r.e for r in shown) == sorted(t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in expected)
    assert merkle.with_next(docs_of([(1, "a")]).limit(0)).count() == 0
    assert [tuple(r) for r in merkle.with_next(docs_of([(1, "ab")])).collect()] == [(1, "ab", "ab")]


def test_query(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.tree_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    roots = {}
    for k, (i, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        changed = t[: len(t) - len(t) // 2] + follow[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == sha256(changed.encode()).hexdigest()
        for text, root in ((t, r.fingerprint), (changed, r.edited_fingerprint)):
            assert roots.setdefault(text, root) == root
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(roots.values())) == len(roots)
    far = [r for r in got.values() if r.n_chars > 100]
    assert sum(r.near_edited > r.near_next for r in far) > 0.95 * len(far)


def test_trees_tell_texts_apart_and_find_edits(spark):
    lines = [f"line {k} of the text" for k in range(60)]
    cases = {"same": lines, "edit": [*lines[:20], "another line", *lines[21:]], "insert": [*lines[:5], "put in", *lines[5:]], "gone": lines[1:], "swap": [lines[1], lines[0], *lines[2:]], "space": [*lines[:59], lines[59] + " "]}
    frame = spark.createDataFrame([("\n".join(lines), k, "\n".join(v)) for k, v in cases.items()], "old string, case string, new string")
    trees = frame.select("case", merkle.tree(F.col("old")).alias("o"), merkle.tree(F.col("new")).alias("n"))
    out = {r.case: r for r in trees.select("case", "o", "n", merkle.changed_paragraphs(F.col("o"), F.col("n")).alias("c")).collect()}
    assert {k for k, r in out.items() if r.o.root == r.n.root} == {"same"}
    assert {k: r.c for k, r in out.items()} == {"same": [], "edit": [20], "insert": [5], "gone": [], "swap": [], "space": [59]}
    assert len(set(out["same"].o.sections) & set(out["insert"].n.sections)) >= len(out["same"].o.sections) - 2


def test_null_and_empty_are_alike(docs_of):
    got = [(r.tree.root, r.pieces) for r in merkle.fingerprints(docs_of([(1, None), (2, ""), (2, "")])).collect()]
    assert len(got) == 3 and len({g[0] for g in got}) == 1 and got[0][1] == []
    assert docs_of([(1, "")]).select(merkle.likeness(F.array().cast("array<long>"), F.array().cast("array<long>")).alias("x")).first().x == 1.0


def test_no_python(spark, sf_dir):
    plan = queries.tree_fingerprints(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_tree(text):
    """Root and different leaves."""
    hashed = lambda parts: sha256("".join(parts).encode()).hexdigest()
    lines = (text or "").split("\n")
    leaves = [[sha256(p.encode()).hexdigest() for p in re.findall(merkle._PIECE, line, re.ASCII)] for line in lines]
    sections, own = [], []
    for k, paragraph in enumerate(map(hashed, leaves)):
        own.append(paragraph)
        if k == len(lines) - 1 or xxhash.xxh64_intdigest(paragraph, 42) % merkle.SECTION_PARAGRAPHS == 0 or not lines[k]:
            sections.append(hashed(own))
            own = []
    return hashed(sections), {x for line in leaves for x in line}


def plain_likeness(a, b):
    (one, left), (two, right) = plain_tree(a), plain_tree(b)
    return 1.0 if one == two or not left and not right else 2 * len(left & right) / (len(left) + len(right))


def test_trees_and_likeness_against_plain_ones(spark, sf_dir, texts):
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    long_run = "".join(chr(0x4E00 + k * k % 900) + "、。x"[k % 7 : k % 7 + 1] for k in range(400))
    some = [*texts, *docs, "a\n\nb", "wide　text、" * 30, long_run, "é" + long_run, "  lead", "trail \t", "odd " * 50 + "even"]
    rows = [(a or "", b or "", c or "") for a, b, c in zip(some, some[1:] + some[:1], some[2:] + some[:2])]
    frame = spark.createDataFrame(rows, "text string, edited string, next_text string")
    got = {(r.text, r.edited, r.next_text): (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in merkle.compared(frame).collect()}
    assert got == {(a, b, c): (plain_tree(a)[0], plain_tree(b)[0], plain_likeness(a, b), plain_likeness(a, c)) for a, b, c in rows}
    for text in some:
        assert all("".join(re.findall(merkle._PIECE, line, re.ASCII)) == line for line in (text or "").split("\n"))
    assert plain_likeness(long_run, "é" + long_run) > 0.5


def test_a_word_in_front_keeps_the_likeness(spark):
    text = "one line that holds eight words and ends"
    frame = spark.createDataFrame([(text, "New " + text, text + " again")], "text string, edited string, next_text string")
    got = merkle.compared(frame).first()
    assert 0.5 < got.near_edited < 1 and 0.5 < got.near_next < 1


def test_edits_tell_what_is_added_gone_and_moved(spark):
    lines = [f"line {k} of the text" for k in range(40)]
    cases = {
        "same": (lines, ([], [], [])),
        "edit": ([*lines[:20], "another line", *lines[21:]], ([20], [20], [])),
        "gone": (lines[1:], ([], [0], [])),
        "swap": ([lines[1], lines[0], *lines[2:]], ([], [], [0, 1])),
        "both": ([lines[1], "put in", lines[0], *lines[2:39]], ([1], [39], [0, 2])),
        "empty": ([], ([0], list(range(40)), [])),
    }
    frame = spark.createDataFrame([(k, "\n".join(lines), "\n".join(new)) for k, (new, _) in cases.items()], "case string, old string, new string")
    trees = frame.select("case", merkle.tree(F.col("old")).alias("o"), merkle.tree(F.col("new")).alias("n"))
    got = {r.case: (r.e.added, r.e.gone, r.e.moved) for r in trees.select("case", merkle.edits(F.col("o"), F.col("n")).alias("e")).collect()}
    assert got == {k: expected for k, (_, expected) in cases.items()}


def test_outlying_ids_leave_even_groups(spark):
    for ids in ([*range(20_000), 10**18], [-(10**18), *range(5_000), *range(10**15, 10**15 + 5_000), 10**18], [3] * 700 + list(range(3000))):
        docs = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
        groups, own = merkle._groups(docs)
        sizes = docs.select(own.alias("range")).join(groups, "range").groupBy("group").count().collect()
        assert sum(r["count"] for r in sizes) == len(ids) and len(sizes) >= len(ids) // merkle.GROUP_DOCS // 2
        assert max(r["count"] for r in sizes) <= max(2 * merkle.GROUP_DOCS, ids.count(3) + merkle.GROUP_DOCS)
