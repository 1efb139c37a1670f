"""Every stage, on what the one before kept, against the plain versions of its operator's tests."""

import duckdb
import pytest

import corpus_pipeline
from lettora.llm.line_dedup import LineSpec
from lettora.llm.quality_rules import RuleLimits, quality_verdicts
from lettora.llm.tables import table
from lettora.sources.shared import written
from .test_decontamination import plain_leaks
from .test_line_dedup import plain as plain_lines
from .test_mixing import check as check_mix
from .test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    steps = dict(corpus_pipeline.STAGES)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], FOLDER), "test-stage"))
        if len(out) <= len(steps):
            assert out[-1].schema.simpleString() == docs.schema.simpleString()
    raw, good, cut, one, clean, mixed = out

    verdicts = {r.doc_id: r for r in quality_verdicts(docs, table(spark, FOLDER, "labels")).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, r in verdicts.items() if r.kept}
    assert all(r.kept is False for r in verdicts.values() if r.n_words < RuleLimits().min_words)
    expected = [(d, t) for d, t, _, _ in plain_lines(rows(good, "doc_id", "text"), LineSpec())]
    assert rows(cut, "doc_id", "text") == sorted(expected, key=repr)
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    marks = [(d, plain_fingerprint(t)) for d, t in rows(cut, "doc_id", "text")]
    assert {r.doc_id for r in one.collect()} == {c for _, _, c in plain_components(marks)}
    items = rows(table(spark, FOLDER, "benchmark"), "item_id", "text")
    leaked = {r[0] for r in plain_leaks(rows(one, "doc_id", "text"), items)}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - leaked
    check_mix(mixed.collect(), [(r.doc_id, r.source, r.text) for r in clean.collect()])
    assert rows(corpus_pipeline.run(spark, FOLDER), "doc_id", "taken") == rows(mixed, "doc_id", "taken")


@pytest.mark.parametrize("shape", ["empty", "odd"])
def test_stages_take_odd_documents(spark, shape, tmp_path):
    docs = table(spark, FOLDER, "documents")
    if shape == "empty":
        docs = docs.limit(0)
    else:
        odd = spark.createDataFrame([(None, None, None, None, None), (3, "", None, "src1", 0)], docs.schema)
        docs = docs.where("doc_id < 60").union(odd).union(docs.where("doc_id < 5"))
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "test-stage")
    assert (docs.count() == 0) == (shape == "empty")


def test_registered():
    from __spark_entry__ import oracle_sql, queries

    assert queries()["pipeline"] is corpus_pipeline.run
    assert duckdb.__version__ and "pipeline" not in oracle_sql()
