"""Every operator and pipeline stage on edge rows, on an empty table, and with
extra columns whose names clash with those used inside."""

from __future__ import annotations

import pytest

from vigil.llm import chat, decontam, langid, linededup, mixing, pii, quality, simhash, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(None, 1, 1), (1, None, None), (5, 1, 0), (5, 1, 0), (6, 0, 1), (99, 0, 1)], LABELS)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(None, None), (1, ""), (2, "the same id with another text")], "item_id long, text string")


def operators(labels, bench):
    return {
        "decontam.scan": lambda d: decontam.scan(d, bench),
        "pii.replace": lambda d: pii.replace(d, "k"),
        "quality.ledger": quality.ledger,
        "langid.identify": langid.identify,
        "linededup.line_report": linededup.line_report,
        "mixing.mix_report": lambda d: mixing.mix_report(d, [3, 1, 2]),
        "toxicity.with_scores": lambda d: toxicity.with_scores(d, labels),
        "simhash.group": simhash.group,
    }


NAMES = list(operators(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_document(edge_docs, no_docs, labels, bench, name):
    op = operators(labels, bench)[name]
    out = op(edge_docs).collect()
    assert sorted((r.doc_id for r in out), key=repr) == sorted((r.doc_id for r in edge_docs.select("doc_id").collect()), key=repr)
    assert op(no_docs).count() == 0


def test_simhash_edges(edge_docs):
    rows = simhash.group(edge_docs).collect()
    # null, empty and blank texts share fingerprint zero; the smallest id among them is 1
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    # a group of null ids only has no smallest id
    assert [r.doc_id for r in rows if r.component_id is None] == [None]


def test_pipeline_stages_on_edges(spark, edge_docs, no_docs, tmp_path, labels, bench):
    import corpus_pipeline

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, edge_docs, str(tmp_path))
        assert out.columns == edge_docs.columns and out.dtypes == edge_docs.dtypes, name
        assert out.count() > 0, name
        assert stage(spark, no_docs, str(tmp_path)).count() == 0, name
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.columns == edge_docs.columns and done.count() > 0


def test_empty_lookup_tables(spark, edge_docs, labels, bench):
    assert toxicity.keep_clean(edge_docs, labels.limit(0)).count() == edge_docs.count()
    assert decontam.decontaminate(edge_docs, bench.limit(0)).count() == edge_docs.count()
    one = labels.filter("toxic = 0")
    assert toxicity.keep_clean(edge_docs, one).count() == edge_docs.count()


def test_chat_digest_edges(spark):
    rows = [(None, 1, "assistant", "a"), (None, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.read_back(chat.format_windows(turns)).collect()}
    assert (out[None].n_turns, out[None].loss_chars, out[1].n_turns, out[1].loss_chars) == (2, 1, 2, 0)
    assert chat.read_back(chat.format_windows(turns.limit(0))).count() == 0
