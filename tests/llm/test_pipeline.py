"""The pipeline's stages, and each query against its SQL on the smallest tables."""

import pytest

import check
import corpus_pipeline
from tallyroll.llm import jaccard, packing, quality_rules, toxicity
from tallyroll.llm.oracles import ORACLES
from tallyroll.llm.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf, name):
    verdict, _ = check.compare(spark, check.duck(sf), name, QUERIES[name], ORACLES.get(name), sf)
    assert verdict.startswith("ok" if name in ORACLES else "rows"), verdict


def test_every_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by_rules = corpus_pipeline.quality(spark, docs, sf)
    passing = quality_rules.ledger(docs).filter(quality_rules.passes())
    assert by_rules.columns == docs.columns and {r.doc_id for r in by_rules.collect()} == {r.doc_id for r in passing.collect()}
    clean = corpus_pipeline.non_toxic(spark, by_rules, sf)
    scored = toxicity.score(by_rules, toxicity.fit(by_rules, spark.read.parquet(f"{sf}/labels.parquet")))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.filter("NOT toxic").collect()}
    single = corpus_pipeline.one_of_each_group(spark, clean, sf)
    classes = jaccard.jaccard_classes(clean)
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == {r.component_id for r in classes.collect()}
    pieces = corpus_pipeline.packed(spark, single, sf)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in single.collect()}
    assert docs.count() > by_rules.count() >= clean.count() > single.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, pieces.collect()))


def test_odd_documents_pass_all_stages(spark, sf, make):
    good = " ".join(f"plain{k}" for k in range(40))
    docs = make([(1, good), (2, good), (None, good), (3, None), (4, ""), (5, good + " and some more words of its own " + " ".join(f"x{k}" for k in range(60))), (1, good), (6, " ".join(f"y{k}" for k in range(30000)))], extra=True)
    expected = {1, 5, 6}  # of four rows with the same text, one of them without an id, one stays
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        if name == "ngram_jaccard":
            assert sorted(r.doc_id for r in docs.collect()) == [1, 5, 6]
    assert name == "packing" and {r.doc_id for r in docs.collect()} == expected


def test_stages_take_empty_tables(spark, sf, make):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make([]), sf).collect() == []


def test_one_row_of_each_component_stays(spark, sf, make):
    """Repeated ids: each row is judged by its own text; null ids are copies like others."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    docs = make([(1, a), (1, b), (2, b), (None, c), (None, c), (3, a + " more"), (4, None), (4, None), (5, "")], extra=True)
    rows = corpus_pipeline.one_of_each_group(spark, docs, sf)
    assert rows.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in rows.collect()), key=repr) == sorted([(1, a), (1, b), (None, c), (4, None), (4, None), (5, "")], key=repr)
