"""Registered queries against SQL, and all operators on empty tables and odd rows."""

import pytest
from compare import connect, difference

import corpus_pipeline
from shoptally.llm import (
    fingerprints,
    mixing,
    near_dups,
    packing,
    quality_rules,
    queries,
    secrets,
    suffix_dedup,
    token_counts,
    toxicity,
)

SF_DIR = "/root/testdata/sf0.001"
REPORTS = {
    "suffix": suffix_dedup.report,
    "fingerprints": fingerprints.report,
    "rules": quality_rules.report,
    "tokens": token_counts.report,
    "secrets": secrets.report,
    "near": near_dups.report,
    "mix": mixing.report,
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", REPORTS)
def test_one_row_per_row(odd_docs, name):
    out = REPORTS[name](odd_docs)
    assert out.count() == odd_docs.count()
    wanted = sorted(str(r.doc_id) for r in odd_docs.collect())
    assert sorted(str(r.doc_id) for r in out.collect()) == wanted


@pytest.mark.parametrize("name", REPORTS)
def test_empty_table(odd_docs, name):
    assert REPORTS[name](odd_docs.where("doc_id = -1")).count() == 0


def test_toxicity_without_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, None), (99, 0, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.report(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and {r.score for r in rows} == {0.0} and {r.predicted for r in rows} == {0}
    assert toxicity.report(odd_docs.limit(0), labels.limit(0)).count() == 0


def test_packing_odd_rows(odd_docs):
    rows = packing.pack(odd_docs).collect()
    assert {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert packing.pack(odd_docs.limit(0)).count() == 0


def test_pipeline_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        docs = kept
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_pipeline_stages_on_odd_rows(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd_docs, odd_docs.limit(0)):
            out = stage(spark, docs, SF_DIR)
            assert out.columns == odd_docs.columns, name
            out.collect()


def test_stages_take_effect(spark, make_docs):
    clean = "the house of the king is on the hill and it was built by men from the north in a long cold winter that year " * 1
    noisy = " ".join("word###" for _ in range(40))
    near = clean.replace("king", "queen", 1)
    words = " ".join(f"the{i}" if i % 3 else "the" for i in range(60))
    docs = make_docs([(1, clean, "a"), (2, noisy, "a"), (3, words, "a"), (4, words + " end", "a"), (5, near, "b")])
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    assert ids(stages["quality rules"](spark, docs, "")) == [1, 3, 4, 5]
    assert ids(stages["near duplicates"](spark, docs, "")) == [1, 2, 3, 5]
    told = make_docs([(1, "my password = hunter22hunter and more", "a")])
    row = stages["secrets"](spark, told, "").first()
    assert row.text == "my [SECRET] and more" and row.n_chars == len(row.text)


def test_near_duplicates_keep_one_of_repeated_rows(spark, make_docs):
    docs = make_docs([(3, "a b c d e f", "a")] * 3 + [(2, "a b c d e f", "a"), (9, None, "a"), (9, None, "a")])
    kept = near_dups.keep_first(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(2, "a b c d e f")]
    again = near_dups.keep_first(make_docs([(3, "a b c d e f", "a")] * 3))
    assert again.count() == 1
