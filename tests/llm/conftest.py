import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang, source]) tuples."""

    def make(rows, schema=DOCS):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(SF).exists():
        pytest.skip("shared tables not present")
    return spark.read.parquet(f"{SF}/documents.parquet")
