"""Repeated passages against every window of a small table."""

import hashlib
import random
from collections import Counter

import pytest

from sigloom.llm import suffix_repeats


def brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def expected(docs):
    return sorted((i is None, i or 0, *r) for (i, *_), r in zip(docs, brute([d[1] for d in docs])))


def corpus():
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh ijé") for _ in range(n))
    shared, long = noise(199), noise(900)
    docs = [noise(rng.randint(0, 900)) for _ in range(40)]
    docs += [noise(rng.randint(0, 300)) + long[rng.randint(0, 400) : rng.randint(500, 900)] + noise(rng.randint(0, 300)) for _ in range(40)]
    docs += [noise(50) + shared + noise(50) for _ in range(4)] + [shared + "q", shared + "q" + noise(9), "q" + shared]
    docs += [long, long, long[1:], long[:-1], "ab" * 150, "x" * 201, "x" * 200, "y" * 200, "é" * 101]
    return docs


def test_cover():
    for shift in range(suffix_repeats.PERIOD):
        assert any((d + shift) % suffix_repeats.PERIOD in suffix_repeats.COVER for d in suffix_repeats.COVER)


def test_against_all_windows(docs_of):
    docs = list(enumerate(corpus())) + [(None, None), (None, ""), (3, "again"), (3, corpus()[3])]
    assert rows(suffix_repeats.removed_bytes(docs_of(docs).repartition(5))) == expected(docs)


def test_blocks_change_nothing(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BLOCK_BYTES", 700)
    docs = list(enumerate(corpus()))
    assert rows(suffix_repeats.removed_bytes(docs_of(docs).coalesce(1))) == expected(docs)


def test_spans_and_rest(docs_of):
    docs = [(k, t) for k, t in enumerate(corpus())]
    for r in suffix_repeats.repeats(docs_of(docs)).collect():
        data, at, left = docs[r.doc_id][1].encode(), 0, b""
        for s in r.removed:
            assert at <= s.start < s.end
            left, at = left + data[at : s.start], s.end
        assert left + data[at:] == bytes(r.kept)


def test_awkward_and_empty(docs_of, texts):
    docs = list(enumerate([t for t in texts if len(t or "") < 5000] + ["word " * 500, "z" * 3000]))
    assert rows(suffix_repeats.removed_bytes(docs_of(docs))) == expected(docs)
    assert suffix_repeats.removed_bytes(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        suffix_repeats.repeats(docs_of([]), 60)


def test_very_long_texts(docs_of, texts):
    got = {r.doc_id: r for r in suffix_repeats.removed_bytes(docs_of(list(enumerate(texts)))).collect()}
    assert got[6].n_removed == 150_000 and got[7].n_removed == 200_000 and got[7].n_spans == 1


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    from sigloom.llm import queries

    assert rows(queries.QUERIES["op11_suffix_repeats"](spark, sf_dir)) == expected(docs)
