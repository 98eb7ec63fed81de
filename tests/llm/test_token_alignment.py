"""Aligned tokens against a plain walk over both token lists."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece
from tokenizers import Tokenizer

from sigloom.llm import queries, token_alignment

FOLDER = Path(token_alignment.TOKENIZERS)


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(str(FOLDER / token_alignment.FIRST))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=str(FOLDER / token_alignment.SECOND))


def brute(texts, both):
    first, second = both
    letters = token_alignment._byte_letters()
    assert sorted(letters.values()) == list(range(256))
    docs = []
    for text in texts:
        a = b = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        spell_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        pieces = [second.id_to_piece(i) for i in b]
        spell_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
            docs.append(([], [], []))
            continue
        ranges = []
        for ids, spelled in ((a, spell_a), (b, spell_b)):
            at, out = 0, []
            for i, s in zip(ids, spelled):
                out.append((i, at, at + len(s)))
                at += len(s)
            ranges.append(out)
        links, low = [], 0
        for i, s, e in ranges[0]:
            while ranges[1][low][2] <= s:
                low += 1
            k = low
            while k < len(ranges[1]) and ranges[1][k][1] < e:
                links.append((i, ranges[1][k][0]))
                k += 1
        common = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in r if start <= s and e <= end) for r in ranges))
            start = end
        docs.append((ranges, links, groups))
    counts = Counter(p for _, links, _ in docs for p in set(links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    for ranges, links, groups in docs:
        n_best, total = sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)
        sizes = [len(r) for r in ranges] or [0, 0]
        yield (*sizes, len(groups), len(links), n_best, total, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")


def rows(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r.doc_id), *(r[n] for n in names)) for r in df.collect())


AWKWARD = ["<|endoftext|> plain", "<s> </s> <unk>", "a▁b", "  two  spaces ", "tab\tand\nline\r\n", "naïve café 東京 😀😀", "\x00\x01", "x" * 3000]


def test_against_plain_walk(docs_of, both, texts):
    short = [t for t in texts if len(t or "") < 5000] + AWKWARD + ["one two", "one two three"]
    docs = [*enumerate(short), (None, "one two"), (3, "one"), (3, "one")]
    expected = sorted((str(i), *r) for (i, _), r in zip(docs, brute([t for _, t in docs], both)))
    assert rows(token_alignment.alignment(docs_of(docs).repartition(3))) == expected


def test_slices_change_nothing(docs_of, monkeypatch):
    docs = docs_of(list(enumerate(AWKWARD * 3)))
    whole = rows(token_alignment.alignment(docs))
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 40)
    assert rows(token_alignment.alignment(docs.coalesce(1))) == whole


def test_pieces_change_nothing(both, texts):
    import pyarrow as pa

    loaded = token_alignment._loaded(str(FOLDER / token_alignment.FIRST), str(FOLDER / token_alignment.SECOND))
    assert loaded.second_in_pieces
    some = [t or "" for t in texts] + AWKWARD + [" a  b\u00a0 c \u2003 d\x1c e's  's don't  !'s ", "\u0301 a \u0301b  ", "x \x85 y"]
    first, second = loaded.encode(pa.array([(" " + t).encode() for t in some], pa.binary()))
    assert first.to_pylist() == [both[0].encode(" " + t, add_special_tokens=False).ids for t in some]
    assert second.to_pylist() == both[1].encode(some)


def test_long_and_empty(docs_of, texts):
    got = rows(token_alignment.alignment(docs_of(list(enumerate(texts)))))
    assert len(got) == len(texts) and token_alignment.alignment(docs_of([])).collect() == []


def test_whole_table(spark, sf_dir, both):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 6000").collect()]
    got = rows(token_alignment.alignment(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted((str(i), *r) for (i, _), r in zip(docs, brute([t for _, t in docs], both)))
    assert queries.QUERIES["op12_token_alignment"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
