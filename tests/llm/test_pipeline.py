"""The pipeline stage by stage, and every registered query of the subpackage."""

import pytest

import __spark_entry__
import corpus_pipeline
from compare import connect, difference
from sigloom.llm import check_sql, queries


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir)
        if name != "mixing":
            assert after.columns == columns
        assert after.count() <= before.count() and after.join(before, "doc_id", "left_anti").count() == 0
        before = after
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    assert got == sorted(map(tuple, before.collect())) and got


def test_registered():
    registered = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in registered) for k in range(1, 14)) and "pipeline" in registered
    assert set(check_sql.CHECKS) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", [n for n in check_sql.CHECKS if not n.startswith("op13_")])
def test_query_against_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    assert difference(queries.QUERIES[name](spark, sf_dir), con, check_sql.CHECKS[name]) is None
    con.close()


@pytest.fixture
def given(spark):
    """Tables of the pipeline around ``docs``, with labels of both kinds."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, taken_words string, _toxicity string"
    filler = [(100 + k, f"calm words about river number {k} and hill {k * 7} in the north of land {k * 13}", "a") for k in range(30)]
    passage = "the quick survey of nine old bridges found that each one had been built before the great flood of spring"

    def make(rows):
        table = [(i, t, "en", s, len(t or ""), "k", "t", "x") for i, t, s in rows + filler]
        return spark.createDataFrame(table, schema), spark.createDataFrame([(1, passage)], "item_id bigint, text string")

    make.passage = passage
    return make


def test_rows_decide_not_ids(given):
    from sigloom.llm import decontamination, mixing, simhash

    copy = "one fixed text of more than five words that stands here twice"
    docs, benchmark = given(
        [(1, copy, "a"), (2, copy, "a"), (2, "a text of its own under an id that repeats", "a"), (None, copy, "a"), (None, None, "a")]
        + [(None, "see " + given.passage, "a"), (3, "see " + given.passage, "a"), (3, "harmless words under the same id", "b"), (None, "", None)]
    )
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert kept.count((1, copy)) == 1 and (2, copy) not in kept and (None, copy) not in kept
    assert (2, "a text of its own under an id that repeats") in kept and len([t for _, t in kept if not t]) == 1
    clean = [(r.doc_id, r.text) for r in decontamination.keep_clean(docs, benchmark).collect()]
    assert len(clean) == docs.count() - 2 and all(given.passage not in (t or "") for _, t in clean)
    assert (3, "harmless words under the same id") in clean
    two, _ = given([(7, "ten words " * 5, "x"), (7, "only three words", "y")])
    for r in mixing.mixed(two).filter("doc_id = 7").collect():
        assert 0 < r.taken_words <= 2 * len(r.text.split())


def test_stages_on_awkward_tables(spark, given, tmp_path, texts):
    docs, benchmark = given([(k, t, None if k % 2 else "hot") for k, t in enumerate(texts)] + [(None, None, None), (3, "one", "x"), (3, "one", "x")])
    labels = spark.createDataFrame([(100 + k, 1, int(k < 3)) for k in range(30)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, table, str(tmp_path))
            rows = after.collect()
            assert (not rows) == (table is not docs) or name == "toxicity"
            assert set(table.columns) == set(after.columns)
            if name != "personal_data":
                assert {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in table.collect()}


def test_near_duplicates_by_brute_force(spark, sf_dir):
    from sigloom.llm import simhash

    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sets = [set(simhash._shingles(t)) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    classes = {}
    for k, (i, _) in enumerate(docs):
        classes.setdefault(find(k), []).append(i)
    kept = simhash.keep_one(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(min(c) for c in classes.values())
