"""The mix against plain sums."""

from collections import defaultdict

from sigloom.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1)):
    """Shares again and again what goes beyond a limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, target = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in target]
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}


def check(rows):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for source, r in rows:
        sizes[source] += r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        assert 0 <= r.taken <= 2 * r.size
    goals = plain_targets(sizes)
    for source, r in rows:
        assert r.source_size == sizes[source] and abs(r.target - goals[source]) < 1e-6 * max(1, goals[source])
    for source, goal in goals.items():
        assert goal - largest[source] <= taken[source] <= goal + 1e-6


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    check([(source[r.doc_id], r) for r in got])
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_awkward_rows(docs_of, texts):
    rows = [(k, t, s) for k, (t, s) in enumerate((t, s) for t in texts for s in ("b", None, "", "é"))]
    rows += [(900 + k, "w " * k, "hot") for k in range(60)] + [(7, "again and again", "b"), (7, "again and again", "b"), (None, "no id", "b"), (None, None, None)]
    docs = docs_of(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by = {(i, len((t or "").split())): s for i, t, s in rows if i is not None and t != texts[-1]}
    assert by and sum(r.size for r in got) > 0
    again = [r for r in got if r.doc_id == 7 and r.size == 3]
    assert len(again) == 2 and again[0] == again[1]


def test_words_of_texts(docs_of, texts):
    import re

    got = {r.doc_id: r.size for r in mixing.mix(docs_of(list(enumerate(texts)))).collect()}
    assert got == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in enumerate(texts)}


def test_tables_without_words_or_rows(docs_of):
    got = mixing.mix(docs_of([(1, None), (2, "")])).collect()
    assert {(r.size, r.source_size, r.target, r.taken) for r in got} == {(0, 0, 0.0, 0)}
    assert mixing.mix(docs_of([(1, "a")]).limit(0)).count() == 0
    assert mixing.mixed(docs_of([(1, "a")]).limit(0)).count() == 0


def test_mixed_keeps_what_is_taken(docs_of):
    docs = docs_of([(k, "w " * (k % 9), "abc"[k % 3]) for k in range(90)])
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = mixing.mixed(docs).collect()
    assert {r.doc_id: r.taken_words for r in got} == {k: v for k, v in taken.items() if v}


def test_no_python(docs_of):
    plan = mixing.mix(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
