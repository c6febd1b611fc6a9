import hashlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the small documents table."""
    from tests.conftest import SF_SMALL
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
