"""SimHash classes against all pairs in plain Python."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from sigloom.llm import simhash
from sigloom.llm.components import components


def plain_fingerprint(text, words=3):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[k : k + words]) for k in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest id reachable over links of two bits or fewer, by fingerprint."""
    root = {f: f for f in prints.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(root)
    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    lowest = {}
    for i, f in prints.items():
        lowest[find(f)] = min(i, lowest.get(find(f), i))
    return {i: lowest[find(f)] for i, f in prints.items()}


def test_documents_against_all_pairs(spark, sf_dir, docs_of, texts):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(1000 + k, t) for k, t in enumerate(texts)]
    base = rows[3][1].split()
    rows += [(2000 + k, " ".join([*base[:k], "changed", *base[k + 1 :]])) for k in range(0, len(base), 7)]
    expected = {i: plain_fingerprint(t) for i, t in rows}
    classes = plain_classes(expected)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect()}
    assert got == {i: (f"{f:016x}", classes[i]) for i, f in expected.items()}
    assert len(set(classes.values())) < len(set(expected.values()))


def test_links_in_crowded_space(spark, monkeypatch):
    """Fingerprints so close that groups are split down to the last level."""
    monkeypatch.setattr(simhash, "GROUP_LIMIT", 3)
    rng = random.Random(5)
    prints = set()
    for center in (0, (1 << 64) - 1, rng.getrandbits(64)):
        prints |= {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(120)}
        prints |= {center ^ (x << 20) for x in range(40)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.linked(frame).collect()}
    mask = (1 << 64) - 1
    expected = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= 2}
    assert got == expected and expected


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 700)] + [(rng.randint(800, 1000), rng.randint(800, 1000)) for _ in range(90)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == root


def test_ids_repeated_null_and_none(docs_of, spark):
    docs = docs_of([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (2, "A b  c d"), (None, "quite another one here"), (9, None), (8, "")])
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == [("2", "2"), ("5", "2"), ("5", "2"), ("8", "8"), ("9", "8"), ("None", "2"), ("None", "None")]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "8", "None"]  # the copy under a null id goes
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_one_of_repeated_rows(docs_of):
    docs = docs_of([(1, "p q r s"), (1, "p q r s"), (3, "t u v w")])
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 3]


def test_distances_bound_pairs(spark):
    table = simhash.distance_table(spark.createDataFrame([(0,), (3,)], "fp bigint")).collect()
    names = [c for c in table[0].asDict() if c.startswith("d")]
    assert len(names) == simhash.REFERENCES and all(abs(table[0][c] - table[1][c]) <= 2 for c in names)


def test_similar_documents_against_all_pairs(spark, sf_dir, docs_of):
    """Classes hold together by similar pairs alone, and nearly all similar pairs are in one class."""
    rng = random.Random(6)
    base = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = list(enumerate(base))
    for k in range(150):
        words = base[rng.randrange(60)].split()
        for _ in range(max(1, len(words) // 60)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
        rows.append((1000 + k, " ".join(words)))
    shingles = {i: set(simhash._shingles(t)) for i, t in rows}
    similar = {(a, b) for a in shingles for b in shingles if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])}
    root = {i: i for i in shingles}
    for _ in range(len(root)):
        changed = False
        for a, b in similar:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not changed:
            break
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(docs_of(rows)).collect()}
    assert set(got) == set(root) and all(root[i] == root[c] for i, c in got.items())
    together = sum(got[a] == got[b] for a, b in similar)
    assert len(similar) > 60 and together >= 0.9 * len(similar)


def _classes(shingles):
    """Smallest id reachable over pairs that overlap by 0.8, in integers."""
    root = {i: i for i in shingles}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in shingles:
        for b in shingles:
            if a < b and 9 * len(shingles[a] & shingles[b]) >= 4 * (len(shingles[a]) + len(shingles[b])):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in root}


def test_no_similar_pair_is_lost_in_a_crowd(docs_of, monkeypatch):
    """Pairs on the edge of the limit among many documents that share most of their words, common shingles or not."""
    rng = random.Random(8)
    line = [f"line{k}" for k in range(40)]
    rows = []
    for k in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(15, 60))]
        rows.append((2 * k, " ".join(line + own)))
        cut = rng.randint(0, len(own) // 3)
        rows.append((2 * k + 1, " ".join(line + own[cut:] + [f"x{k}y{j}" for j in range(rng.randint(0, 6))])))
    expected = _classes({i: set(simhash._shingles(t)) for i, t in rows})
    assert 60 < len(set(expected.values())) < 240
    for sample, common in ((16, 8), (1, 3)):
        monkeypatch.setattr(simhash, "SAMPLE", sample, raising=False)
        monkeypatch.setattr(simhash, "COMMON", common, raising=False)
        assert {r.doc_id: r.component_id for r in simhash.similar_documents(docs_of(rows)).collect()} == expected
