from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_documents():
    """doc_id to text of the smallest documents table."""
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, lang, source, n_chars) as a documents table."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return build
