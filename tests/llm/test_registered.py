"""Registered queries: names, SQL twins, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from checks import compare
from patchloom.llm import queries
from patchloom.llm.common import table


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, small, name):
    con = compare.connect(small)
    df = queries.QUERIES[name](spark, small)
    rel = con.sql(queries.SQL[name])
    assert compare.difference(df.toPandas(), rel.df()) is None
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: compare.SAME_KIND.get(k) for c, k in compare.spark_kinds(df).items()} == kinds


def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and len(left) > len(ids) / 2
        if i < len(corpus_pipeline.STAGES) - 1:
            assert sorted(out.columns) == sorted(columns)
            docs, ids = out, left
        else:
            assert left == ids
