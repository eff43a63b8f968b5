"""Queries with an SQL twin; the pipeline's stages on the small tables."""

from __future__ import annotations

import compare
import pytest

import corpus_pipeline
from anemos.session import materialize
from anemos.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, sf_dir, name):
    assert compare.differences(queries.queries()[name](spark, sf_dir), compare.connect(sf_dir), oracle.oracle_sql()[name]) == []


def test_pipeline(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
