"""The registered queries against their SQL, and the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline
from conftest import SF001, duck
from helpers import assert_same
from sluice.llm import minhash_forest, mixing, packing, toxicity
from sluice.llm.common import table
from sluice.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert_same(QUERIES[name](spark, SF001).toPandas(), duck(SF001).sql(ORACLE[name]).df())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_is_its_stages_one_after_the_other(spark):
    docs = table(spark, SF001, "documents")
    scores = toxicity.toxicity_scores(docs, table(spark, SF001, "labels"))
    clean = corpus_pipeline.drop_toxic(spark, docs, SF001)
    gone = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - gone
    kept = corpus_pipeline.drop_near_copies(spark, clean, SF001)
    near = minhash_forest.near_duplicate_texts(clean, shingle=5)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in near.where("kept").collect()}
    mixed = corpus_pipeline.mix_sources(spark, kept, SF001)
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(kept).collect()}
    assert mixed.groupBy("doc_id").count().collect() and mixed.count() == sum(copies.values())
    assert clean.columns == kept.columns == mixed.columns == docs.columns
    want = packing.pack_documents(mixed).drop("sequence_id", "offset")
    got = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, got.drop("sequence_id", "offset").collect())) == sorted(map(tuple, want.collect()))
