import re

import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfmark.llm import common, neardup, quality, queries, toxicity
from shelfmark.session import stored


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small, name):
    duck = oracle.connect(small)
    assert oracle.compare(queries.QUERIES[name](spark, small), duck, queries.ORACLES[name]) is None


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "secrets", "packing"]


def test_stages_hand_on_what_they_keep(spark, small):
    docs = common.read(spark, small, "documents")
    labels = common.read(spark, small, "labels")
    seen = [{r.doc_id: r for r in docs.collect()}]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], small), "stage"))
        seen.append(tables[-1].collect())
    good = {r.doc_id for r in quality.grade(docs, quality.train(docs, labels)).where("keep").collect()}
    assert {r.doc_id for r in seen[1]} == good
    toxic = toxicity.grade(tables[1], toxicity.train(docs, labels)).where("toxic")
    assert {r.doc_id for r in seen[2]} == good - {r.doc_id for r in toxic.collect()}
    groups = neardup.groups(tables[2], neardup.Plan(5, 80)).collect()
    assert sorted(r.doc_id for r in seen[3]) == sorted({r.component_id for r in groups})
    for table in tables[1:-1]:
        assert table.dtypes == docs.dtypes
    before = {r.doc_id: r for r in seen[3]}
    assert len(seen[4]) == len(before)
    for r in seen[4]:
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        assert ("[secret]" in r.text) == (r.text != before[r.doc_id].text) or "[secret]" in before[r.doc_id].text
        assert not re.search("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", r.text)
    assert {r.doc_id for r in seen[5]} == set(before)
    assert corpus_pipeline.run(spark, small).count() == len(seen[5])


def test_stages_take_odd_rows(spark, small, rows):
    pairs = [(1, "Some words"), (1, "Some words"), (None, None), (2, ""), (3, "token=abcdefghijklmnop " * 3000)]
    names = "doc_id long, text string"
    for frame in (rows(pairs, names), rows([], names)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, small), "stage")
            assert docs.columns == frame.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
