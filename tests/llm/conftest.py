from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) of the test documents."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
