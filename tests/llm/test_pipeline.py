"""The stages one after the other on awkward documents, and the registered queries."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from quaylake.llm import quality, queries as registered
from quaylake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_pass_on_what_they_keep(session, awkward, rows, tmp_path):
    docs = session.createDataFrame(rows, COLUMNS).repartition(3)
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(session, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        counts.append((name, docs.count(), out.count()))
        docs = out
    assert counts[0][2] == quality.judged(awkward).where("kept").count()
    assert counts[1][1] == counts[1][2] and counts[3][1] == counts[3][2]
    assert 0 < counts[2][2] < counts[2][1]
    packed = corpus_pipeline.STAGES[-1][1](session, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    assert packed.agg({"offset": "min"}).first()[0] == 0


def test_run_over_an_empty_table(session, tmp_path):
    session.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(session, str(tmp_path)).count() == 0


def test_every_operator_has_a_query():
    names = list(queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_languages(session):
    found = QUERIES["op8_language_spans"](session, FOLDER)
    docs = registered.table(session, FOLDER, "documents").select("doc_id", "lang")
    held = found.where("held_out").join(docs, "doc_id")
    assert held.count() > 30 and held.where("lang = lang_pred").count() >= 0.97 * held.count()
