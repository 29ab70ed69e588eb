"""The registered queries: their SQL, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import corpora
import oracle
import pytest

import corpus_pipeline
from shelfmark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf_dir, name):
    rows, difference = oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLE[name])
    assert difference is None and rows > 0


def test_there_is_one_query_an_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


def test_stages_keep_columns_and_only_remove_rows(spark, sf_dir, tmp_path):
    docs = corpora.frame(spark)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        apply(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == docs.columns, name
        before, after = Counter(map(tuple, docs.collect())), Counter(map(tuple, kept.collect()))
        assert after and not after - before, name
        nothing = apply(spark, corpora.empty(spark), sf_dir)
        assert nothing.columns == docs.columns and nothing.count() == 0, name
        docs = kept
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert mixed.count() > 0 and mixed.join(docs, ["doc_id", "text"], "left_anti").filter("doc_id is not null and text is not null").count() == 0


def test_pipeline(spark, sf_dir):
    mixed = corpus_pipeline.run(spark, sf_dir)
    rows = mixed.select("doc_id", "text", "size", "taken").collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 0
    assert len({r["text"] for r in rows}) == len(rows)
    assert all(0 < r["taken"] <= 2 * r["size"] for r in rows)
