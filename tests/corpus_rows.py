"""Small corpora for the tests of this folder."""

from __future__ import annotations

DOC_SCHEMA = "doc_id bigint, old_id bigint, split string, title string, body string, topics array<string>"


def make_docs(spark, rows):
    """rows: (doc_id, split, body, topics[, old_id[, title]])."""
    full = []
    for r in rows:
        doc_id, split, body, topics = r[:4]
        old_id = r[4] if len(r) > 4 else doc_id
        title = r[5] if len(r) > 5 else ""
        full.append((doc_id, old_id, split, title, body, topics))
    return spark.createDataFrame(full, DOC_SCHEMA)
