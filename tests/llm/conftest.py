from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import DOCS, SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def raw_docs(spark):
    """(doc_id, text) of the small table and the special rows."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    return rows + DOCS(rows)


@pytest.fixture(scope="session")
def docs(spark, raw_docs):
    """The same as a table, with columns whose names operators use inside."""
    rows = [(d, x, "en", "s", len(x or ""), 1, 2, 3) for d, x in raw_docs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, block int, slot int, kept int").repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
