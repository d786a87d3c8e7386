"""Short boilerplate goes like any other; only empty lines stay out."""

from __future__ import annotations

import corpus_pipeline
from quaylake.llm import linededup


def test_short_lines_on_many_sites_go(session, tmp_path):
    texts = [f"Share\n\ntext {i} of its own\n!\n \t" for i in range(6)] + ["Home\nShare", "Home\nmore"]
    rows = [(i, t, "en", f"s{i}", len(t)) for i, t in enumerate(texts)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(session, docs, str(tmp_path)).collect()}
    assert out == {0: texts[0]} | {i: f"\ntext {i} of its own\n \t" for i in range(1, 6)} | {6: "Home", 7: texts[7]}


def test_a_document_of_many_lines(session):
    """A hundred thousand lines that all go: time in proportion to them, not to their square."""
    lines = [f"line {i} of all" for i in range(100_000)]
    rows = [(d, "\n".join(lines), "en", f"s{d}", 0) for d in range(6)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["id"]: r for r in linededup.report(docs.repartition(3)).collect()}
    assert found[0]["kept_text"] == rows[0][1] and found[0]["n_removed"] == 0
    assert all(found[d]["kept_text"] == "" and found[d]["n_removed"] == 100_000 for d in range(1, 6))
